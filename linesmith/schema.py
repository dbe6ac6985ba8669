"""Column lists and Spark types of the odds tables."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import types as T


@dataclass(frozen=True)
class Spec:
    """What is declared about a column: its place, type, market and how it is shown."""

    group: str
    place: int
    type: T.DataType
    show: str = "raw"
    market: str | None = None
    book: int = 0


# Names, order, types and display of the columns of weekly files.
_META = [("game_id", T.LongType()), ("team_id", T.LongType()), ("season", T.IntegerType()),
         ("week", T.IntegerType()), ("team", T.StringType()), ("date", T.StringType()),
         ("time", T.StringType()), ("score", T.IntegerType()), ("outcome", T.StringType()),
         ("rotation", T.IntegerType())]
_OPENING = [("moneyline", "moneyline", "signed"), ("spread", "spread", "signed"),
            ("spread_odds", "spread", "signed"), ("total", "total", "raw"),
            ("total_odds", "total", "signed")]
_CONSENSUS = [("moneyline_bet_pct", "moneyline", "percent"), ("moneyline_dollar_pct", "moneyline", "money"),
              ("spread_bet_pct", "spread", "percent"), ("spread_dollar_pct", "spread", "money"),
              ("total_bet_pct", "total", "percent"), ("total_dollar_pct", "total", "money")]
_BOOK = [("moneyline", "moneyline", "signed"), ("spread", "spread", "raw"),
         ("spread_odds", "spread", "signed"), ("total", "total", "raw"),
         ("total_odds", "total", "signed")]
PREVIEW_COLS = ["team", "date", "score", "outcome", "opening_spread",
                "opening_moneyline", "opening_total"]

GROUPS = ("meta", "opening", "consensus", "book", "other")
_SPECS = {name: Spec("meta", i, kind) for i, (name, kind) in enumerate(_META)}
_SPECS |= {f"opening_{name}": Spec("opening", i, T.DoubleType(), show, market)
           for i, (name, market, show) in enumerate(_OPENING)}
_SPECS |= {name: Spec("consensus", i, T.DoubleType(), show, market)
           for i, (name, market, show) in enumerate(_CONSENSUS)}
_BOOK_SPECS = {name: Spec("book", i, T.DoubleType(), show, market)
               for i, (name, market, show) in enumerate(_BOOK)}
META_COLS = [name for name, _ in _META]
OPENING_COLS = [f"opening_{name}" for name, *_ in _OPENING]
CONSENSUS_COLS = [name for name, *_ in _CONSENSUS]
BOOK_METRICS = [name for name, *_ in _BOOK]


def spec_of(column: str) -> Spec:
    """The declared spec; an unknown column is a number, shown as it is, in the last group."""
    if column in _SPECS:
        return _SPECS[column]
    book, _, metric = column.partition("_")
    if book.isdigit() and metric in _BOOK_SPECS:
        return replace(_BOOK_SPECS[metric], book=int(book))
    return Spec("other", 0, T.DoubleType())


# The fields of a record in an odds response; every one may be
# missing, and ids may come as numbers or as texts.
RECORD_FIELDS = [("eid", "bigint"), ("mtid", "int"), ("boid", "bigint"), ("partid", "bigint"),
                 ("sbid", "bigint"), ("paid", "int"), ("lineid", "bigint"), ("wag", "double"),
                 ("perc", "double"), ("vol", "double"), ("tvol", "double"), ("sequence", "bigint"),
                 ("tim", "bigint"), ("ap", "double"), ("adj", "double")]
RECORD = T.StructType([T.StructField(name, T.StringType()) for name, _ in RECORD_FIELDS])
RESPONSE_PARTS = {"opening": "A_OL", "current": "A_CL", "consensus": "A_CO"}
RESPONSE = T.StructType([T.StructField("data", T.StructType(
    [T.StructField(part, T.ArrayType(RECORD)) for part in RESPONSE_PARTS.values()]))])
#: Holds a response that does not fit the types as it stands.
WHOLE = "__whole"
_KINDS = {"bigint": T.LongType(), "int": T.IntegerType(), "double": T.DoubleType()}
#: With a place for the count of wrong fields, which no response fills.
BAD = "__bad"
TYPED_RECORD = T.StructType([T.StructField(name, _KINDS[kind]) for name, kind in [*RECORD_FIELDS, (BAD, "int")]])
TYPED_RESPONSE = T.StructType([T.StructField("data", T.StructType(
    [T.StructField(part, T.ArrayType(TYPED_RECORD)) for part in RESPONSE_PARTS.values()])), T.StructField(WHOLE, T.StringType())])

PAGE_CAPTURE = T.StructType([
    T.StructField("season", T.IntegerType()), T.StructField("week", T.IntegerType()),
    T.StructField("url", T.StringType()), T.StructField("html", T.StringType())])


def book_id(column: str) -> int | None:
    """The book a ``{book}_{metric}`` column belongs to, or None."""
    head = column.split("_", 1)[0]
    return int(head) if head.isdigit() else None


def weekly_schema(columns: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, spec_of(c).type) for c in columns])


def canonical_order(columns: list[str]) -> list[str]:
    """Columns by group, book and declared place; unknown ones last, as they come."""
    def rank(column: str) -> tuple[int, int, int]:
        spec = spec_of(column)
        return GROUPS.index(spec.group), spec.book, spec.place
    return sorted(columns, key=rank)


def total_columns(columns: list[str]) -> list[str]:
    """Columns of the totals market, which belong to a game and not to a team."""
    return [c for c in columns if spec_of(c).market == "total"]
