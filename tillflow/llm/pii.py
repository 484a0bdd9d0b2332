"""Personal data in texts, in DataFrame functions only: expressions propose spans, checksums confirm, context scores.

Every kind has one expression whose matches are leftmost and do not overlap. The pieces of text between the matches give
their places, so one pass splits and one pass extracts. The expressions are written so that a scan stays linear on long
runs of letters, digits or blanks: repetition is possessive where what follows cannot begin inside it, and no
match is tried from the middle of a run whose beginning has failed (unless the last match ended there). The end of an
account number shows by its checksum only, so its expression looks ahead over the longest run (at most 34 characters and
the blanks between them) from each word that may begin one, and the prefixes of the run that end with a word are tried.

A span's score starts from what confirmed it (a checksum more than a form), rises with words that speak for the kind
within CONTEXT characters around it, and falls with words that speak against it. Spans that a form or checksum confirms are kept
whatever their score. Dates of birth and passport numbers look like any date or part number: for them the words decide, and a span
below the least score of its kind goes.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CONTEXT = 40
_SPAN = "struct<kind:string,start:bigint,end:bigint,score:double>"


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    needs: str  # an expression that every text with a match has: a cheap first look
    score: float
    speaks_for: str
    speaks_against: str = "(?i)order|version|isbn|serial|invoice"
    base: bool = True
    least: float = 0.0  # spans below this score go
    ahead: bool = False  # a match is one character, its first group the run that the span begins


_MAIL = "A-Za-z0-9._%+-"
KINDS = (
    Kind(
        "email",
        rf"(?:\G|(?<![{_MAIL}]))[{_MAIL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        "@",
        0.8,
        "(?i)e-?mail|contact|write to|mailto",
        "(?i)git@|example only",
    ),
    Kind(
        "ip",
        r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
        r"[0-9]\.[0-9]",
        0.6,
        r"(?i)\bip\b|address|host|server|login",
        "(?i)version|release|section",
    ),
    Kind("card", "[0-9](?:[ -]?[0-9])++", "[0-9]", 0.7, "(?i)card|visa|master|payment|credit|debit"),
    Kind("phone", r"\+[0-9][ ().0-9-]+[0-9]", r"\+[0-9]", 0.6, r"(?i)phone|tel\b|call|mobile|fax"),
    Kind(
        "iban",
        # The run takes one more letter or digit if its last word goes on, so that this word is no end.
        "(?<![A-Za-z0-9])(?=([A-Z]{2}[0-9]{2}(?:[ ]?[A-Z0-9]){11,30}+[A-Za-z0-9]?))[A-Z]",
        "[A-Z]{2}[0-9]{2}",
        0.7,
        r"(?i)iban|bank|account|konto|\bbic\b",
        base=False,
        ahead=True,
    ),
    Kind(
        "birth_date",
        "(?<![0-9])(?:(?:19|20)[0-9]{2}-(?:0[1-9]|1[0-2])-(?:0[1-9]|[12][0-9]|3[01])|(?:0?[1-9]|[12][0-9]|3[01])[./](?:0?[1-9]|1[0-2])[./](?:19|20)[0-9]{2})(?![0-9])",
        r"(?i)\bborn\b|birth|\bdob\b",
        0.4,
        r"(?i)\bborn\b|birth|\bdob\b",
        base=False,
        least=0.5,
    ),
    Kind("passport", "(?<![A-Za-z0-9])[A-Z]{1,2}[0-9]{6,8}(?![A-Za-z0-9])", "(?i)passport", 0.4, "(?i)passport", base=False, least=0.5),
)

# Characters of an account number by country.
_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB NI PL SV",
    29: "BR EG PS QA UA", 30: "JO KW MU", 31: "MT SC", 32: "LC", 33: "RU",
}


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether the digits pass the Luhn check; every second digit from the right counts twice, digit by digit."""
    total = F.aggregate(
        F.sequence(F.lit(1), F.length(digits)),
        F.lit(0),
        lambda acc, i: acc
        + F.element_at(
            F.when((F.length(digits) - i) % 2 == 1, F.array(*map(F.lit, [0, 2, 4, 6, 8, 1, 3, 5, 7, 9]))).otherwise(
                F.array(*map(F.lit, range(10)))
            ),
            F.substring(digits, i, 1).cast("int") + 1,
        ),
    )
    return total % 10 == 0


def _mod_97(code: Column) -> Column:
    """Whether an account number, its first four characters moved to the end and letters read as 10 to 35, leaves 1."""
    plain = F.regexp_replace(code, " ", "")
    turned = F.concat(F.substring(plain, 5, 40), F.substring(plain, 1, 4))

    def add(acc: Column, c: Column) -> Column:
        return (acc * F.when(c >= 65, 100).otherwise(10) + F.when(c >= 65, c - 55).otherwise(c - 48)) % 97

    rest = F.aggregate(F.transform(F.split(turned, ""), F.ascii), F.lit(0), add)
    return F.length(plain).between(15, 34) & (rest == 1)


def _valid(kind: str, match: Column) -> Column:
    if kind == "ip":
        return ~F.exists(F.split(match, r"\."), lambda p: F.length(F.regexp_replace(p, "^0+", "")) > 3) & ~F.exists(
            F.split(match, r"\."), lambda p: F.right(p, F.lit(9)).cast("int") > 255
        )
    if kind == "card":
        return F.when(F.length(_digits(match)).between(13, 19), _luhn(_digits(match))).otherwise(False)
    if kind == "phone":
        return F.length(_digits(match)).between(9, 15)
    return F.lit(True)


def _account(run: Column) -> Column:
    """The account number that a run begins with, null if none: of the prefixes that end with a word and pass the checksum

    the one as long as its country has it, else the longest.
    """
    words = F.split(run, " ")
    prefixes = F.transform(F.sequence(F.lit(1), F.size(words)), lambda n: F.array_join(F.slice(words, 1, n), " "))
    passed = F.filter(prefixes, lambda p: ~F.rlike(p, F.lit("[a-z]")) & _mod_97(p))
    lengths = F.create_map(*[F.lit(x) for n, codes in _LENGTHS.items() for code in codes.split() for x in (code, n)])
    usual = F.coalesce(F.try_element_at(lengths, F.left(run, F.lit(2))), F.lit(0))

    def rank(p: Column) -> Column:
        length = F.length(F.regexp_replace(p, " ", ""))
        return F.struct((length == usual).alias("usual"), length.alias("length"), p.alias("number"))

    return F.array_max(F.transform(passed, rank))["number"]


def _spans(text: Column, kind: Kind) -> Column:
    """The valid spans of one kind, in order. Places are counted in code points, the end is exclusive."""
    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast(f"array<{_SPAN}>").alias("found"))

    def step(state: Column, part: Column) -> Column:
        begin = state["at"] + F.length(part["0"])
        end = begin + F.coalesce(F.length(part["1"]), F.lit(0))
        past = begin + 1 if kind.ahead else end
        around = F.substr(text, F.greatest(begin - CONTEXT + 1, F.lit(1)).cast("int"), (end - begin + 2 * CONTEXT).cast("int"))
        score = F.lit(kind.score) + F.when(F.rlike(around, F.lit(kind.speaks_for)), 0.2).otherwise(0.0)
        score = score - F.when(F.rlike(around, F.lit(kind.speaks_against)), 0.3).otherwise(0.0)
        span = F.struct(F.lit(kind.name).alias("kind"), begin.alias("start"), end.alias("end"), score.alias("score"))
        valid = F.when(part["1"].isNull(), False).otherwise(_valid(kind.name, part["1"]))
        if kind.least:
            valid = valid & (score >= kind.least)
        if kind.ahead:
            valid = valid & (begin >= F.coalesce(F.try_element_at(state["found"], F.lit(-1))["end"], F.lit(0)))
        found = F.when(valid, F.concat(state["found"], F.array(span.cast(_SPAN)))).otherwise(state["found"])
        return F.struct(past.alias("at"), found.alias("found"))

    between = F.split(text, kind.pattern, -1)
    matches = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(int(kind.ahead)))
    if kind.ahead:
        matches = F.transform(matches, _account)
    found = F.aggregate(F.arrays_zip(between.alias("0"), matches.alias("1")), start, step, lambda state: state["found"])
    none = F.array().cast(f"array<{_SPAN}>")
    return F.when(F.rlike(text, F.lit(kind.needs)), found).otherwise(none)


def find(docs: DataFrame, text: str = "text", into: str = "pii") -> DataFrame:
    """``docs`` with a column ``into``, an array of ``kind, start, end, score``, kinds in the order of KINDS, then by start.

    A null or empty text has no spans. Kinds are found apart from each other, so spans of two kinds may overlap. Other
    columns are kept; a column of that name is replaced. Rows are independent, repeated rows get equal spans.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    return docs.withColumn(into, F.concat(*[_spans(whole, kind) for kind in KINDS]))


def count(spans: Column, kind: str) -> Column:
    """How many of the spans are of a kind."""
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")


def shown(spans: Column) -> Column:
    """``kind:start:end`` of the spans, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def scores(spans: Column) -> Column:
    """Scores of the spans, in tenths, joined by commas in the order of :func:`shown`."""
    return F.array_join(F.transform(spans, lambda s: F.round(s["score"] * 10).cast("int").cast("string")), ",")


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with every span replaced by its kind in angle brackets; overlapping spans become one, named by the first."""
    names = docs.columns
    spans = F.array_sort(F.transform("_pii", lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("end"), s["kind"].alias("kind"))))
    state = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<string>").alias("out"))

    def step(state: Column, s: Column) -> Column:
        end = -s["end"]
        before = F.substr(text, (state["at"] + 1).cast("int"), (s["start"] - state["at"]).cast("int"))
        grown = F.struct(end.alias("at"), F.concat(state["out"], F.array(before, F.concat(F.lit("<"), s["kind"], F.lit(">")))).alias("out"))
        longer = F.struct(F.greatest(state["at"], end).alias("at"), state["out"].alias("out"))
        return F.when(s["start"] >= state["at"], grown).otherwise(longer)

    def join(state: Column) -> Column:
        return F.concat(F.array_join(state["out"], ""), F.substr(text, (state["at"] + 1).cast("int"), F.length(text)))

    found = find(docs, text, "_pii")
    clean = F.when(F.size("_pii") > 0, F.aggregate(spans, state, step, join)).otherwise(F.col(text))
    return found.withColumn("_clean", clean).select(*[F.col("_clean").alias(n) if n == text else F.col(f"`{n}`") for n in names])
