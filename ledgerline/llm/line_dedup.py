"""Line deduplication by a segment-partition edit join; DataFrame functions only.

Lines are compared in a normal form: lower case, white space runs as one space, trimmed.

* Exact repeats, of all lines that are not blank: one row for each distinct line, told apart by 128 bits
  (partial aggregation folds a very common line inside each task); all but its first
  place, by (doc_id, position), count as repeats.  They go, but lines of fewer than ``MIN_CHARS``
  characters stay in the text unless ``drop_short`` is set: they repeat in sound texts, too.
* Near repeats: distinct lines within ``EDITS`` edits of each other are linked.  A line goes
  if it is linked to a line whose first place is earlier.  Lines of fewer than ``MIN_CHARS``
  characters are within that distance by chance and are not linked.

The join: a line of n characters is cut into EDITS + 1 segments of nearly equal
length.  EDITS edits leave one segment intact in any line within that distance, and
only few starts can hold it there (the shift is limited by the lengths and by the
segment's number).  So each line is indexed once for each segment, under (its
length, segment number, segment), and probes the indexes of lines up to EDITS
shorter with the substrings at those starts.  A line's index entries are among its probes (its own
segments at their own starts), so one table of keys serves both: it is dealt by key
once, folded to one row for each key with the smallest and largest line of both kinds, and rows that
meet no other line go.  The rest get their lines' texts, and the join on the key
returns the pairs that ``levenshtein(a, b, EDITS)``, which computes the diagonal band
only, verifies: pairs that merely share a segment are never made.

Defined results: NULL and empty texts have no lines and stay as they are; blank lines are
kept; rows with NULL id are left alone; rows that share an id are one document, so
their equal lines at equal positions are one line; an empty table gives an empty
result; extra columns are ignored by ``dedup_lines`` and kept by ``without_repeated_lines``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import written

MIN_CHARS = 24
EDITS = 2
MOST_COMMON = 100_000
REPEATS = 100  # lines up to here are not common


def _squeezed(text: Column) -> Column:
    """``text`` with runs of white space as one space and none at the ends of lines."""
    # Most texts have no white space but single spaces inside lines and line breaks.
    odd = text.startswith(" ") | text.endswith(" ")
    for spaces in ("\t", "\x0b", "\f", "\r", "  ", " \n", "\n "):
        odd = odd | text.contains(spaces)
    squeezed = F.regexp_replace(text, "[ \\t\\x0B\\f\\r]+", " ")
    return F.when(odd, F.trim(F.regexp_replace(squeezed, " ?\n ?", "\n"))).otherwise(text)


def with_normal_form(docs: DataFrame) -> DataFrame:
    """``docs`` with ``normal``: the text with its lines in normal form."""
    # A column of its own: generators and lambdas would compute it again for each use.
    return docs.withColumn("lower_text", F.lower("text")).withColumn("normal", _squeezed(F.col("lower_text"))).drop("lower_text")


def all_lines(docs: DataFrame) -> DataFrame:
    """``doc_id, pos, line`` (normal form) and its length ``n``, of the lines that are not blank."""
    lines = with_normal_form(docs.select("doc_id", "text").where("doc_id is not null and text is not null")).select(
        # Not posexplode(): that infers a filter on the lines, which would make the normal form twice.
        "doc_id", F.posexplode_outer(F.split("normal", "\n")).alias("pos", "line")
    )
    return lines.withColumn("n", F.length("line")).where(F.col("n") > 0)


def line_hashes(line: Column) -> tuple[Column, Column]:
    """128 bits of a line: ``id`` and ``id2``."""
    return F.xxhash64(line).alias("id"), F.xxhash64(F.lit("line"), line).alias("id2")


def _place(doc_id: Column, pos: Column) -> Column:
    """(doc_id, pos) as one number that sorts alike; decimals aggregate in hash tables, structs don't."""
    return (doc_id.cast("decimal(20,0)") * F.lit(2**32).cast("decimal(11,0)") + pos).cast("decimal(38,0)")


def _places(edits: int) -> list[tuple[int, int, int]]:
    """(how much shorter the indexed line is, segment number, shift) of the substrings that a line probes with."""
    return [
        (less, i, shift)
        for less in range(edits + 1)
        for i in range(edits + 1)
        for shift in range(max(-i, less - (edits - i)), min(i, less + (edits - i)) + 1)
    ]


def with_line_keys(lines: DataFrame, edits: int, min_chars: int) -> DataFrame:
    """``lines`` (``line, n``) with ``keys``: for each place the key of the substring that an intact segment of a
    line at most ``edits`` shorter can be; NULL for lines under ``min_chars``."""
    parts = edits + 1
    # The cuts of each length are columns of their own, which keeps the keys' expression small enough to be compiled.
    cuts = {}
    for less in range(edits + 1):
        m = F.col("n") - less
        cuts |= {f"longer_{less}": m % parts, f"base_{less}": F.floor(m / parts).cast("int")}

    def key(less: int, i: int, shift: int) -> Column:
        # The last `longer` segments have one character more.
        longer, base = F.col(f"longer_{less}"), F.col(f"base_{less}")
        start = base * i + F.greatest(F.lit(0), longer + (i - parts)) + (shift + 1)
        size = base + F.when(longer >= parts - i, 1).otherwise(0)
        return F.xxhash64(F.col("n") - less, F.lit(i), F.substring(F.col("line"), start, size))

    keys = F.when(F.col("n") >= min_chars, F.array(*[key(*place) for place in _places(edits)]))
    return lines.withColumns(cuts).withColumn("keys", keys).drop(*cuts)


def line_keys(lines: DataFrame, edits: int) -> DataFrame:
    """``id, key, own``: the ``keys`` of each line (``id, keys``); ``own``: of its own segments, under which it is indexed."""
    own = [at for at, (less, _, shift) in enumerate(_places(edits)) if less == 0 and shift == 0]
    return lines.select("id", F.posexplode("keys").alias("at", "key")).select("id", "key", F.col("at").isin(*own).alias("own"))


def partnered_keys(lines: DataFrame, edits: int) -> DataFrame:
    """``id, key, probes, indexed``: keys under which a line meets another one, as probe or as index entry."""
    # A dozen rows for each line, and a hash table of them in each task: smaller parts than other shuffles have.
    parts = 4 * int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Dealt once, read twice: for each key's ends, and for the rows that meet them.
    keys = line_keys(lines, edits).repartition(parts, "key")
    own = F.when(F.col("own"), F.col("id"))
    ends = (
        keys.groupBy("key")
        .agg(F.min(own).alias("low"), F.max(own).alias("high"), F.min("id").alias("least"), F.max("id").alias("most"))
        .where("low is not null and least != most")
    )
    probes = (F.col("low") != F.col("id")) | (F.col("high") != F.col("id"))
    indexed = F.col("own") & ((F.col("least") != F.col("id")) | (F.col("most") != F.col("id")))
    met = keys.join(ends.hint("shuffle_hash"), "key").select("id", "key", probes.alias("probes"), indexed.alias("indexed"))
    return met.where("probes or indexed").groupBy("id", "key").agg(
        F.max("probes").alias("probes"), F.max("indexed").alias("indexed")
    )


def near_links(lines: DataFrame, texts_of, edits: int) -> DataFrame:
    """``a, a2, b, b2``: pairs of lines (``id, keys``) within ``edits`` of each other, each pair once.

    ``texts_of(ids)`` gives ``id, id2, line`` for a table of ids.
    """
    partnered = written(partnered_keys(lines, edits), "partners")
    named = partnered.join(texts_of(partnered.select("id").distinct()), "id")
    left = named.where("probes").select(
        "key", F.struct("id", "id2").alias("a"), F.col("line").alias("line_a"), F.col("indexed").alias("both_ways")
    )
    right = named.where("indexed").select("key", F.struct("id", "id2").alias("b"), F.col("line").alias("line_b"))
    # Two lines that are both indexed under a key also probe each other: one way is enough.
    once = F.when(F.col("both_ways"), F.col("a") < F.col("b")).otherwise(F.col("a") != F.col("b"))
    close = once & (F.levenshtein("line_a", "line_b", edits) >= 0)
    pair = left.join(right, "key").where(close).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    return pair.select(
        F.col("a.id").alias("a"), F.col("a.id2").alias("a2"), F.col("b.id").alias("b"), F.col("b.id2").alias("b2")
    ).distinct()


def repeated_lines(docs: DataFrame, *, edits: int = EDITS, min_chars: int = MIN_CHARS) -> DataFrame:
    """``doc_id, pos, short, exact, near, links`` of every line that is not blank."""
    if min_chars <= 2 * edits:
        raise ValueError("lines must be longer than twice the edits")
    plain = docs.select("doc_id", "text").where("doc_id is not null")
    lines = all_lines(plain)
    # Places, line numbers and keys, without texts, are read several times.
    short = (F.col("n") < min_chars).alias("short")
    keyed = with_line_keys(lines, edits, min_chars).select("doc_id", "pos", short, *line_hashes(F.col("line")), "keys")
    rows = written(keyed, "lines").withColumn("place", _place(F.col("doc_id"), F.col("pos")))
    firsts = rows.groupBy("id", "id2").agg(F.min("place").alias("first"))

    def texts_of(ids: DataFrame) -> DataFrame:
        """From the document and position where a line stands first."""
        base = F.lit(2**32).cast("decimal(11,0)")
        doc = F.floor(F.col("first") / base)
        at = ids.join(firsts, "id").select(
            "id", "id2", doc.cast("long").alias("doc_id"), (F.col("first") - doc * base).cast("int").alias("pos")
        )
        # One row for each document, so that its text is split once.
        wanted = at.groupBy("doc_id").agg(F.collect_list(F.struct("id", "id2", "pos")).alias("wanted"))
        held = with_normal_form(plain.join(wanted, "doc_id")).select(
            F.inline_outer(
                _with(
                    F.split("normal", "\n"),
                    lambda lines: F.transform(
                        "wanted", lambda w: F.struct(w["id"].alias("id"), w["id2"].alias("id2"), F.get(lines, w["pos"]).alias("line"))
                    ),
                )
            )
        )
        # Rows that share an id may hold other lines there.
        same = [hashed == F.col(c) for hashed, c in zip(line_hashes(F.col("line")), ("id", "id2"))]
        return held.where(same[0] & same[1]).distinct()

    # Of a line with more than one in MOST_COMMON of all places (fewer than MOST_COMMON lines, a broadcast of
    # a proven size) only the first place makes keys, so no key is dealt more rows than that by one line.
    common = rows.groupBy("id").agg(F.count(F.lit(1)).alias("times"), F.min("place").alias("only"))
    common = common.where(F.col("times") > F.greatest(F.lit(REPEATS), rows.agg(F.count(F.lit(1))).scalar() / MOST_COMMON))
    once = rows.where("not short").join(F.broadcast(common.select("id", "only")), "id", "left").where(
        F.col("only").isNull() | (F.col("only") == F.col("place"))
    )
    links = near_links(once.select("id", "keys"), texts_of, edits)
    both = (
        links.join(firsts.select(F.col("id").alias("a"), F.col("id2").alias("a2"), F.col("first").alias("first_a")), ["a", "a2"])
        .join(firsts.select(F.col("id").alias("b"), F.col("id2").alias("b2"), F.col("first").alias("first_b")), ["b", "b2"])
        .select(
            F.inline(
                F.array(
                    F.struct(F.col("a").alias("id"), F.col("a2").alias("id2"), (F.col("first_b") < F.col("first_a")).alias("later")),
                    F.struct(F.col("b").alias("id"), F.col("b2").alias("id2"), (F.col("first_a") < F.col("first_b")).alias("later")),
                )
            )
        )
    )
    near = both.groupBy("id", "id2").agg(F.max("later").alias("near"), F.count(F.lit(1)).alias("links"))
    marked = firsts.join(near, ["id", "id2"], "left")
    return rows.join(marked, ["id", "id2"]).select(
        "doc_id",
        "pos",
        "short",
        (F.col("place") != F.col("first")).alias("exact"),
        F.coalesce("near", F.lit(False)).alias("near"),
        F.coalesce("links", F.lit(0)).alias("links"),
    )


def _by_document(docs: DataFrame, edits: int, min_chars: int, drop_short: bool) -> DataFrame:
    """Per document that has repeated or linked lines: what goes, and counts."""
    marked = repeated_lines(docs, edits=edits, min_chars=min_chars).where("exact or near or links > 0")
    goes = (F.col("exact") | F.col("near")) & (F.lit(drop_short) | ~F.col("short"))
    # One row for each place: rows that share an id count once.
    return (
        marked.distinct()
        .groupBy("doc_id")
        .agg(
            F.collect_list(F.when(goes, F.col("pos"))).alias("gone"),
            F.count_if(F.col("exact")).alias("n_exact"),
            F.count_if(F.col("near") & ~F.col("exact")).alias("n_near"),
            F.sum("links").alias("n_links"),
        )
    )


def _with(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, also inside higher-order functions."""
    return F.get(F.transform(F.array(value), use), 0)


def _kept_text(text: Column, gone: Column) -> Column:
    def rest(lines: Column) -> Column:
        kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), gone)
        return F.array_join(F.transform(kept, lambda i: F.get(lines, i)), "\n")

    return _with(F.split(text, "\n"), rest)


def dedup_lines(
    docs: DataFrame, *, edits: int = EDITS, min_chars: int = MIN_CHARS, drop_short: bool = False
) -> DataFrame:
    """Per row: ``doc_id, n_lines, n_exact, n_near, n_links, text`` (without the repeated lines)."""
    found = _by_document(docs, edits, min_chars, drop_short)
    text = F.when(F.size("gone") > 0, _kept_text(F.col("text"), F.col("gone"))).otherwise(F.col("text"))
    n_lines = F.size(F.array_remove(F.split(_squeezed(F.col("text")), "\n"), ""))
    plain = docs.select("doc_id", "text")
    # Rows with an id meet the findings in the same order in which the lines' texts were fetched.
    met = plain.where("doc_id is not null").join(found, "doc_id", "left")
    every = met.unionByName(plain.where("doc_id is null"), allowMissingColumns=True)
    return every.select(
        "doc_id",
        F.coalesce(n_lines, F.lit(0)).cast("long").alias("n_lines"),
        *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_exact", "n_near", "n_links")],
        text.alias("text"),
    )


def without_repeated_lines(
    docs: DataFrame, *, edits: int = EDITS, min_chars: int = MIN_CHARS, drop_short: bool = False
) -> DataFrame:
    """``docs`` with its own columns and the texts that are left (``n_chars`` follows).

    A document of which only blank lines would be left goes; one without
    repeated lines stays as it is.
    """
    document = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    packed = docs.select(F.col("doc_id").alias("doc_id"), F.col("text").alias("text"), document.alias("document"))
    found = _by_document(docs, edits, min_chars, drop_short).select("doc_id", "gone").where(F.size("gone") > 0)
    left = packed.join(found, "doc_id", "left").withColumn(
        "left_text", F.when(F.col("gone").isNotNull(), _kept_text(F.col("text"), F.col("gone"))).otherwise(F.col("text"))
    )
    stays = F.col("gone").isNull() | F.col("left_text").rlike("\\S")
    columns = {
        "text": F.col("left_text"),
        "n_chars": F.when(F.col("gone").isNull(), F.col("document.n_chars")).otherwise(F.length("left_text"))
        if "n_chars" in docs.columns
        else None,
    }
    types = dict(docs.dtypes)
    return left.where(stays).select(
        *[
            (columns[c].cast(types[c]) if columns.get(c) is not None else F.col(f"document.`{c}`")).alias(c)
            for c in docs.columns
        ]
    )
