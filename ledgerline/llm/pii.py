"""Personal data in texts: regular expressions propose, checksums and context decide.

Built-in SQL functions only.  Each kind has a pattern; ``regexp_extract_all`` and ``split`` with
the same pattern give the matches and the text between them, whose lengths add up to
code point offsets.

* ``email``, ``ip``, ``card`` and ``phone`` are the base kinds: a match that passes its check (parts
  up to 255; 12 to 19 digits and Luhn; 9 to 15 digits) is always reported.
* ``iban`` (mod-97) and ``ssn`` are added.  Their score starts from the pattern, rises
  with a valid checksum and with a context word in the ``CONTEXT`` characters before the match,
  and they are reported from ``MIN_SCORE`` on: a valid account number of a country in
  ``IBAN_LENGTHS`` and of that length always, a bare ``ddd-dd-dddd`` only near a word that
  announces it.

Every reported span carries its score; context raises the base kinds' scores too.

The patterns are written so that Java's matcher neither recurses nor starts again inside
a run of the same characters: possessive groups, and a start only where the previous character is
of another class or the previous match ended.

Defined results: NULL and empty texts have no spans; rows are independent, so
repeated rows give equal results; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import sha256_of_joined

#: Kinds in the order that breaks ties of a start.
KINDS = ("email", "ip", "card", "phone", "iban", "ssn")
BASE_KINDS = KINDS[:4]
CONTEXT = 40
MIN_SCORE = 0.5

# The registered length of the account numbers of each country.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK",
    21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL",
    24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM",
    28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}


def _iban() -> str:
    """One alternative for each length, so that text after a number is never part of it."""
    numbers = "|".join(
        rf"(?:{'|'.join(codes.split())})[0-9]{{2}}(?:\x20?[A-Z0-9]){{{n - 4}}}+" for n, codes in IBAN_LENGTHS.items()
    )
    return rf"(?<![A-Za-z0-9])(?:{numbers})(?![A-Za-z0-9])"


_LOCAL = "[A-Za-z0-9._%+-]"
PATTERNS = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": _iban(),
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
}
# What a text must contain to be searched; cheap to test.
_HINTS = {
    "email": lambda t: t.contains("@"),
    "ip": lambda t: t.rlike(r"[0-9]\.[0-9]"),
    "card": lambda t: t.rlike(r"[0-9][0-9\x20-]{11}"),
    "phone": lambda t: t.rlike(r"\+[0-9]"),
    "iban": lambda t: t.rlike(r"[A-Z]{2}[0-9]{2}\x20?[A-Z0-9]"),
    "ssn": lambda t: t.rlike(r"[0-9]{3}-[0-9]{2}-[0-9]{4}"),
}
_START_SCORE = {"email": 0.8, "ip": 0.6, "card": 0.4, "phone": 0.6, "iban": 0.2, "ssn": 0.2}
_CHECKSUM = 0.4  # added for Luhn and mod-97
_NEAR_WORD = 0.3  # added for a context word
_CONTEXT_WORDS = {
    "email": r"(?i)\b(e-?mail|mail|contact|write|kontakt|correo)\b",
    "ip": r"(?i)\b(ip|host|server|address|adresse)\b",
    "card": r"(?i)\b(card|credit|visa|mastercard|karte|carte|tarjeta)\b",
    "phone": r"(?i)\b(phone|tel|call|mobile|fax|telefon|t[eé]l[eé]phone|tel[eé]fono)\b",
    "iban": r"(?i)\b(iban|account|bank|konto|compte|cuenta)\b",
    "ssn": r"(?i)\b(ssn|social|security)\b",
}
_SPAN = "array<struct<start:int,kind_no:int,end:int,kind:string,score:double>>"


def _where_valid(kind: str, match: Column) -> Column:
    digits = F.regexp_replace(match, "[^0-9]", "")
    n = F.length(digits)
    if kind == "ip":
        # No integer cast: a part can have any number of digits.
        return F.forall(F.split(match, r"\."), lambda p: F.regexp_replace(p, "^0+", "").rlike(r"^(|[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"))
    if kind == "card":
        return F.when(n.between(12, 19), luhn(digits)).otherwise(F.lit(False))
    if kind == "phone":
        return n.between(9, 15)
    if kind == "iban":
        return mod97(F.regexp_replace(match, " ", ""))
    return F.lit(True)


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    backwards = F.split(F.reverse(digits), "")
    values = F.transform(
        F.filter(backwards, lambda d: d != ""),
        lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(
            F.when(d.cast("int") > 4, 2 * d.cast("int") - 9).otherwise(2 * d.cast("int"))
        ),
    )
    return F.aggregate(values, F.lit(0), lambda a, b: a + b) % 10 == 0


def mod97(account: Column) -> Column:
    """Whether an account number (letters A-Z and digits, no spaces) has remainder 1."""
    turned = F.concat(F.substring(account, 5, 1000), F.substring(account, 1, 4))
    return (
        F.aggregate(
            F.filter(F.split(turned, ""), lambda c: c != ""),
            F.lit(0),
            lambda a, c: F.when(c.rlike("[0-9]"), (a * 10 + c.try_cast("int")) % 97).otherwise(
                (a * 100 + F.ascii(c) - 55) % 97
            ),
        )
        == 1
    )


_STEP = 64


def running_sums(lengths: Column) -> Column:
    """Sums before each element.  In two levels, so that many elements cost no square."""

    def before(values: Column) -> Column:
        start = F.struct(F.lit(0).alias("sum"), F.array().cast("array<int>").alias("out"))
        return F.aggregate(
            values,
            start,
            lambda acc, x: F.struct((acc["sum"] + x).alias("sum"), F.array_append(acc["out"], acc["sum"]).alias("out")),
            lambda acc: acc["out"],
        )

    groups = F.transform(
        F.sequence(F.lit(0), F.greatest(F.lit(0), F.ceil(F.size(lengths) / _STEP).cast("int") - 1)),
        lambda g: F.slice(lengths, g * _STEP + 1, F.lit(_STEP)),
    )
    sums = F.transform(groups, lambda g: F.aggregate(g, F.lit(0), lambda a, b: a + b))
    return F.flatten(
        F.transform(F.arrays_zip(groups.alias("g"), before(sums).alias("s")), lambda z: F.transform(before(z["g"]), lambda x: x + z["s"]))
    )


def kind_spans(text: Column, kind: str) -> Column:
    """All valid matches of one kind, by start."""
    pattern = F.lit(PATTERNS[kind])
    matches = F.regexp_extract_all(text, pattern, F.lit(0))
    between = F.split(text, PATTERNS[kind], -1)
    # Lengths of text and match in turn; every match ends before the next text.
    steps = F.zip_with(F.slice(between, 1, F.size(matches)), matches, lambda b, m: F.length(b) + F.length(m))
    placed = F.zip_with(
        F.zip_with(running_sums(steps), F.slice(between, 1, F.size(matches)), lambda s, b: s + F.length(b)),
        matches,
        lambda start, m: F.struct(start.alias("start"), m.alias("m")),
    )
    valid = F.filter(placed, lambda p: _where_valid(kind, p["m"]))

    def span(p: Column) -> Column:
        start = p["start"]
        left = F.greatest(F.lit(0), start - CONTEXT)
        context = F.substring(text, left + 1, start - left)
        score = (
            F.lit(_START_SCORE[kind] + (_CHECKSUM if kind in ("card", "iban") else 0.0))
            + F.when(context.rlike(_CONTEXT_WORDS[kind]), _NEAR_WORD).otherwise(0.0)
        )
        return F.struct(
            start.cast("int").alias("start"),
            F.lit(KINDS.index(kind)).alias("kind_no"),
            (start + F.length(p["m"])).cast("int").alias("end"),
            F.lit(kind).alias("kind"),
            F.least(F.lit(1.0), score).alias("score"),
        )

    spans = F.transform(valid, span)
    if kind not in BASE_KINDS:
        spans = F.filter(spans, lambda s: s["score"] >= MIN_SCORE)
    searched = F.when(_HINTS[kind](text) & (F.size(matches) > 0), spans.cast(_SPAN))
    return F.coalesce(searched, F.array().cast(_SPAN))


def find_personal_data(docs: DataFrame) -> DataFrame:
    """Per row: ``doc_id, text, found`` (spans by start, then kind, with scores)."""
    # Each kind is a column of its own, so that no expression is computed twice.
    plain = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))
    each = plain.select("doc_id", "text", *[kind_spans(F.col("text"), k).alias(k) for k in KINDS])
    return each.select("doc_id", "text", F.array_sort(F.concat(*KINDS)).alias("found"), *KINDS)


def mask_personal_data(docs: DataFrame) -> DataFrame:
    """``doc_id, text`` with each span that no earlier span covers replaced by ``<kind>``."""
    found = find_personal_data(docs)
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    masked = F.aggregate(
        "found",
        start,
        lambda acc, s: F.when(
            s["start"] >= acc["at"],
            F.struct(
                s["end"].alias("at"),
                F.concat(
                    acc["out"], F.substring(F.col("text"), acc["at"] + 1, s["start"] - acc["at"]), F.lit("<"), s["kind"], F.lit(">")
                ).alias("out"),
            ),
        ).otherwise(acc),
        lambda acc: F.concat(acc["out"], F.substring(F.col("text"), acc["at"] + 1, F.length("text"))),
    )
    return found.select("doc_id", masked.alias("text"))


def personal_data_digest(docs: DataFrame) -> DataFrame:
    """Per row: counts of the base kinds, the base spans' digest, all spans as text."""
    found = find_personal_data(docs)

    def written(spans: Column) -> Column:
        return F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))

    base = F.filter("found", lambda s: s["kind_no"] < len(BASE_KINDS))
    return found.select(
        "doc_id",
        *[F.size(k).cast("long").alias(f"n_{k}") for k in BASE_KINDS],
        sha256_of_joined(written(base)).alias("base_sha256"),
        F.array_join(written(F.col("found")), ",").alias("spans"),
    )
