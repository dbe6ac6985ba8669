"""License wordings as marked-up templates.

``<<opt>>`` to ``<</opt>>`` may be missing, ``<<any a-b>>`` stands for a to b
words of any kind, ``<<one x|y z>>`` for one of the phrases.
"""

from __future__ import annotations

# The base phrases and their labels.
BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}

# Wordings of public licenses and of the lines that name them.
TEMPLATES = {
    "mit-text": """
        Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
        documentation files (the "Software"), to deal in the Software without restriction, including without limitation
        the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and
        to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above
        copyright notice and this permission notice <<opt>>(including the next paragraph)<</opt>> shall be included in
        all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY
        KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A
        PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL <<one the authors|<<any 1-12>>>> OR COPYRIGHT HOLDERS
        BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY""",
    "isc-text": """
        Permission to use, copy, modify, and<<opt>>/or<</opt>> distribute this software for any purpose with or without
        fee is hereby granted, provided that the above copyright notice and this permission notice appear in all
        copies""",
    "bsd-text": """
        Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
        following conditions are met: <<any 0-2>> Redistributions of source code must retain the above copyright notice,
        this list of conditions and the following disclaimer. <<any 0-2>> Redistributions in binary form must reproduce
        the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or
        other materials provided with the distribution. <<opt>><<any 0-2>> Neither the name of <<any 1-20>> nor the
        names of its contributors may be used to endorse or promote products derived from this software without specific
        prior written permission.<</opt>> This software is provided by""",
    "apache-2.0": """
        Licensed under the Apache License<<opt>>,<</opt>> <<opt>>Version<</opt>> <<one 2.0|2>>""",
    "apache-2.0-notice": """
        Licensed under the Apache License, Version 2.0 (the "License"); you may not use <<one this file|<<any 1-6>>>> except
        in compliance with the License. You may obtain a copy of the License at
        <<one http|https>>://www.apache.org/licenses/LICENSE-2.0""",
    "gpl-notice": """
        is free software<<one ;|:>> you can redistribute it and/or modify it under the terms of the GNU General Public
        License as published by the Free Software Foundation<<one ;|,>> either version <<any 1-1>> of the License, or
        <<opt>>(at your option)<</opt>> any later version""",
    "gpl-2.0": "GNU General Public License<<opt>>,<</opt>> <<opt>><<one version|v>><</opt>> <<one 2|v2|2.0>>",
    "gpl-3.0": "GNU General Public License<<opt>>,<</opt>> <<opt>><<one version|v>><</opt>> <<one 3|v3|3.0>>",
    "cc-by-nc": "<<one CC|Creative Commons>> <<one BY-NC|Attribution-NonCommercial>> <<opt>><<one SA|ND|ShareAlike|NoDerivatives>><</opt>> <<one 4.0|3.0|2.5|2.0>>",
    "mit": "<<one released|licensed|distributed|available>> under the <<opt>>terms of the<</opt>> MIT license",
}
