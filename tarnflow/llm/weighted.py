"""Document fingerprints by consistent weighted sampling, in DataFrame functions only.

A text is the set of its words (lower-cased, split at white space) with their counts as weights. Each
of 64 samples draws for a word r and c from Gamma(2, 1) and b from Uniform(0, 1), all from hashes of the
word and the sample's number. With weight S, t = floor(ln S / r + b), and the word's rank is
ln a = ln c - r (t - b + 1). The word of smallest rank, with its t, is the sample; two texts share it with
a probability equal to their generalised Jaccard similarity (sum of smaller by sum of larger counts).
Since r, c and b belong to the word, the smallest rank names word and t at once, so it is kept in their place.

Texts are shuffled once, to their row's own hash. All that follows, words, counts, ranks and
minima, is grouped by that hash and stays in the same tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tarnflow.llm.common import numbered, release, written

SAMPLES = 64
#: Samples computed in one row: few enough for generated code that is compiled whole.
TOGETHER = 4
#: White space that parts words.
SPACE = "[ \\t-\\r]"
ROW = ["_a", "_b"]


def _named(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Key and text (null: empty) with two hashes of both, which tell rows apart without their text."""
    rows = docs.select(docs[key].alias("_key"), F.coalesce(docs[text].cast("string"), F.lit("")).alias("_text"))
    told = F.coalesce(F.col("_key").cast("string"), F.lit("-"))
    return rows.withColumns({"_a": F.xxhash64(told, "_text"), "_b": F.xxhash64("_text", F.lit(1), told)})


def _half(bits: Column, high: bool) -> Column:
    """A number in (0, 1) from half of 64 bits."""
    part = F.shiftrightunsigned(bits, 32) if high else bits.bitwiseAND(F.lit(0xFFFFFFFF))
    return (part.cast("double") + 0.5) / 4294967296.0


def _draws(j: int) -> list[Column]:
    """r, ln c and b of the ``j``-th sample of a group; each draw hashes the one before."""
    first = F.xxhash64("_seed", F.lit(j))
    second = F.xxhash64(first)
    third = F.xxhash64(second)
    r, c = -F.log(_half(first, True) * _half(first, False)), -F.log(_half(second, True) * _half(second, False))
    return [r.alias(f"_r{j}"), F.log(c).alias(f"_c{j}"), _half(third, True).alias(f"_u{j}")]


def _ranks(j: int, names: list[str]) -> list[Column]:
    """Smallest rank of the ``j``-th sample of a group, for each of the columns of log weights."""
    r, c, b = F.col(f"_r{j}"), F.col(f"_c{j}"), F.col(f"_u{j}")
    return [F.min(c - r * (F.floor(F.col(n) / r + b) - b + 1.0)).alias(f"{n}_{j}") for n in names]


def signatures(words: DataFrame, names: list[str]) -> DataFrame:
    """One fingerprint a row and name, from (``_a``, ``_b``, ``_word`` hash, log weights under ``names``, null for none).

    128 bytes, two a sample, so other samples agree by chance once in 65536; texts without words have
    zeros. Rows that have the same hashes are one.
    """
    grouped = words.withColumn("_group", F.explode(F.sequence(F.lit(0), F.lit(SAMPLES // TOGETHER - 1))))
    # Drawn once for all names, in a step of their own.
    seeded = grouped.select(*ROW, *names, "_group", F.xxhash64("_word", "_group").alias("_seed"))
    drawn = seeded.select(*ROW, *names, "_group", *[x for j in range(TOGETHER) for x in _draws(j)])
    least = drawn.groupBy(*ROW, "_group").agg(*[x for j in range(TOGETHER) for x in _ranks(j, names)])

    def shown(name: str) -> Column:
        each = [F.col(f"{name}_{j}") for j in range(TOGETHER)]
        bits = [F.when(x.isNull(), F.lit(0)).otherwise(F.xxhash64(x).bitwiseAND(F.lit(0xFFFF))) for x in each]
        return F.concat(*[F.lpad(F.hex(x), 4, "0") for x in bits])

    told = least.select(*ROW, F.struct("_group", *[shown(n).alias(n) for n in names]).alias("_told"))
    told = told.groupBy(*ROW).agg(F.sort_array(F.collect_list("_told")).alias("_told"))
    return told.select(*ROW, *[F.unhex(F.array_join(F.col(f"_told.{n}"), "")).alias(n) for n in names])


def likeness(a: Column, b: Column) -> Column:
    """Share of equal samples of two fingerprints (binary)."""
    same = [(F.substring(a, 2 * k + 1, 2) == F.substring(b, 2 * k + 1, 2)).cast("int") for k in range(SAMPLES)]
    total = same[0]
    for x in same[1:]:
        total = total + x
    return total / float(SAMPLES)


def counted(pieces: DataFrame, names: list[str]) -> DataFrame:
    """Log counts of each word, by its hash: ``pieces`` has ``_piece`` and, under ``names``, 1 where the piece counts.

    A row without any word keeps one entry without weights.
    """
    words = pieces.select(*ROW, *names, F.explode(F.split(F.lower("_piece"), f"{SPACE}+")).alias("_w"))
    held = [F.sum(F.when(F.col("_w") != "", F.col(n)).otherwise(0)).alias(n) for n in names]
    words = words.groupBy(*ROW, F.xxhash64("_w").alias("_word")).agg(*held)
    return words.withColumns({n: F.when(F.col(n) > 0, F.log(n)) for n in names})


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key and ``fingerprint`` of every row; null texts count as empty, repeated rows come as often as they are there.

    Equal texts have equal fingerprints, texts without words have zeros only. An empty table gives no rows.
    """
    rows = _named(docs, key, text)
    named = rows.groupBy(*ROW).agg(F.min("_text").alias("_piece")).withColumn("fingerprint", F.lit(1))
    made = written(signatures(counted(named, ["fingerprint"]), ["fingerprint"])).withColumn("fingerprint", F.lower(F.hex("fingerprint")))
    return rows.select(*ROW, F.col("_key").alias(key)).join(made, ROW).drop(*ROW)


def edited(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited text, whose last floor(n/2) code points are the first of the next one.

    Next is the row after it by falling key (nulls last, rows of one key by a hash of their text), after the
    last the first. Rows alike in key and text are one row there, and come in the result as often as
    they are in the table. Null texts are empty; an empty table gives no rows. Columns: key, ``n_chars``,
    ``edited_sha256``, ``fingerprint``, ``edited_fingerprint``, ``near_edited`` and ``near_next``, the likeness of the
    fingerprint to that of the edited text and to the next row's.
    """
    rows = _named(docs, key, text)
    known = written(rows.groupBy(*ROW).agg(F.min("_key").alias("_key"), F.max(F.length("_text")).cast("bigint").alias("n_chars"), F.count("*").alias("_copies")))
    total = known.count()
    placed = written(numbered(known, [], [F.col("_key").desc_nulls_last(), F.col("_a"), F.col("_b")], "_at"))
    after = placed.select(F.col("_at").alias("_next"), F.col("_a").alias("_na"), F.col("_b").alias("_nb"))
    placed = written(placed.withColumn("_next", F.when(F.col("_at") + 1 < total, F.col("_at") + 1).otherwise(0)).join(after, "_next").drop("_at", "_next"))
    texts = rows.groupBy(*ROW).agg(F.min("_text").alias("_text"))
    cut = F.floor(F.col("n_chars") / 2).cast("int")
    donors = texts.select(F.col("_a").alias("_na"), F.col("_b").alias("_nb"), F.col("_text").alias("_given"))
    given = placed.join(donors, ["_na", "_nb"]).select(*ROW, F.substring("_given", F.lit(1), cut).alias("_given"))
    both = texts.join(placed.select(*ROW, "n_chars"), ROW).join(given, ROW)
    both = both.withColumn("_edited", F.concat(F.substring("_text", F.lit(1), (F.col("n_chars") - cut).cast("int")), "_given"))
    # Words before the last white space ahead of the cut are counted once for both texts.
    shared = F.regexp_extract(F.substring("_text", F.lit(1), (F.col("n_chars") - cut).cast("int")), f"(?s)^.*{SPACE}", 0)
    both = both.withColumn("_shared", shared)
    rest = lambda c: F.substring(c, F.length("_shared") + 1, F.length(c))
    pieces = F.array(
        F.struct(F.col("_shared").alias("_piece"), F.lit(1).alias("fingerprint"), F.lit(1).alias("edited_fingerprint")),
        F.struct(rest(F.col("_text")).alias("_piece"), F.lit(1).alias("fingerprint"), F.lit(0).alias("edited_fingerprint")),
        F.struct(rest(F.col("_edited")).alias("_piece"), F.lit(0).alias("fingerprint"), F.lit(1).alias("edited_fingerprint")),
    )
    names = ["fingerprint", "edited_fingerprint"]
    # Both branches read the same exchanges, and the join needs none: everything is kept by row.
    signed = signatures(counted(both.select(*ROW, F.inline(pieces)), names), names)
    sums = both.select(*ROW, F.unhex(F.sha2(F.col("_edited").cast("binary"), 256)).alias("edited_sha256"))
    made = written(signed.join(sums, ROW))
    release(docs.sparkSession)
    nexts = made.select(F.col("_a").alias("_na"), F.col("_b").alias("_nb"), F.col("fingerprint").alias("_nf"))
    compared = placed.join(nexts, ["_na", "_nb"]).join(made, ROW).select(
        *ROW, "n_chars", F.lower(F.hex("edited_sha256")).alias("edited_sha256"), *[F.lower(F.hex(n)).alias(n) for n in names], likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("_nf")).alias("near_next"),
    )
    return rows.select(*ROW, F.col("_key").alias(key)).join(compared, ROW).drop(*ROW)
