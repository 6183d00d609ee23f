"""Document fingerprints by one-permutation MinHash, in column expressions alone.

Each shingle is hashed once. The high byte of its hash names one of 256 bins,
which keeps the least of the rest. Sorting the hashes together with a sentinel
for each bin, larger than all that the bin can hold, gives the bins in order with
one comparison each. An empty bin borrows from the first full one of a sequence
of bins hashed from its own number, which is the same for every document
(optimal densification), and mixes in that number. A bin is stored as its low
8 bits, so unequal bins agree by chance once in 256, which the estimate takes out.
"""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Words of a shingle. Bins and stored bits are fixed by the layout of a hash.
SHINGLE, BINS, BITS = 5, 256, 8
#: Rows of a run of neighbouring ids, on average, and the most runs.
RUN, MOST_RUNS = 1024, 20_000

_REST = "cast(72057594037927935 as bigint)"  # the low 56 bits
_FULL = f"(x & {_REST}) <> {_REST}"


def fingerprint(df: DataFrame, text: str, out: str) -> DataFrame:
    """``df`` with ``out``, 512 lowercase hex digits: a byte for each bin.

    Letters count in lower case and words are parted by white space. A text of
    fewer than five words is one shingle; a null text or one without words has
    the empty string. Equal texts have equal fingerprints.
    """
    words = df.withColumn("_words", F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"\s+"), ""))
    hashed = words.withColumn("_words", F.expr("transform(_words, w -> xxhash64(w))")).withColumn("_n", F.size("_words"))
    parts = ", ".join(f"_words[i + {k}]" for k in range(SHINGLE))
    shingles = hashed.withColumn(
        "_hashes", F.expr(f"""CASE WHEN _n >= {SHINGLE} THEN transform(sequence(0, _n - {SHINGLE}), i -> xxhash64({parts}))
                              ELSE array(xxhash64(_words)) END"""),
    )
    sentinels = f"transform(sequence(-128L, 127L), b -> shiftleft(b, 56) | {_REST})"
    ordered = shingles.withColumn("_sorted", F.expr(f"sort_array(concat(_hashes, {sentinels}))"))
    least = ordered.withColumn(
        "_bins", F.expr("filter(_sorted, (x, i) -> i = 0 OR shiftright(x, 56) <> shiftright(_sorted[greatest(i - 1, 0)], 56))")
    )
    # Ever longer stretches of the sequence, the next only where one was not enough; at last the following bins.
    stretches = ", ".join(
        f"get(filter(transform(sequence({a}, {b}), t -> _bins[cast(pmod(xxhash64(k, t), {BINS}) as int)]), x -> {_FULL}), 0)"
        for a, b in ((0, 3), (4, 31), (32, 255))
    )
    after = f"get(filter(concat(slice(_bins, k + 1, {BINS}), _bins), x -> {_FULL}), 0)"
    stored = F.expr(f"""transform(_bins, (x, k) -> lpad(hex(255 & CASE WHEN {_FULL} THEN x
                        ELSE xxhash64(coalesce({stretches}, {after}), k) END), 2, '0'))""")
    packed = least.withColumn(out, F.when(F.col("_n") == 0, "").otherwise(F.lower(F.array_join(stored, ""))))
    return packed.drop("_words", "_n", "_hashes", "_sorted", "_bins")


def likeness(a: str, b: str) -> Column:
    """Estimated share of shingles in common of two fingerprints, 0 to 1; of two
    empty ones 1, of an empty and another 0."""
    same = F.expr(f"size(filter(sequence(1, {BINS}), i -> substring(unhex(`{a}`), i, 1) = substring(unhex(`{b}`), i, 1)))")
    by_chance = 1.0 / (1 << BITS)
    estimate = (same / F.lit(float(BINS)) - by_chance) / (1 - by_chance)
    return (
        F.when((F.col(a) == "") | (F.col(b) == ""), (F.col(a) == F.col(b)).cast("double"))
        .otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), estimate)))
    )


def with_next(df: DataFrame, columns: list[str], doc_id: str = "doc_id") -> DataFrame:
    """``df`` with ``next_<c>`` for each of ``columns``, taken from the row that follows in
    descending order of the id; after the last row comes the first.

    Rows of equal id follow each other by the hash of the columns and the
    columns, rows without id come last, and a lone row follows itself. Ids are
    dealt into runs between quantiles, at most ``MOST_RUNS`` numbers that come to
    the driver; rows move once. The first row of a run also goes, as a guest,
    to the run before.
    """
    keyed = df.withColumn("_key", F.coalesce(-F.col(doc_id).cast("double"), F.lit(1e308)))
    size = keyed.agg(F.count("*").alias("n"), F.max(doc_id).alias("first")).first()
    runs = max(1, min(MOST_RUNS, -(-size["n"] // RUN)))
    bounds: list[float] = []
    if runs > 1:
        shares = [k / runs for k in range(1, runs)]
        bounds = sorted(set(keyed.select(F.percentile_approx("_key", shares, 20 * runs)).first()[0]))
    splits = [-float("inf"), *bounds, float("inf")]
    if bounds:
        keyed = Bucketizer(splits=splits, inputCol="_key", outputCol="_run").transform(keyed)
    else:
        keyed = keyed.withColumn("_run", F.lit(0.0))
    last = float(len(bounds))
    first = F.col(doc_id).eqNullSafe(F.lit(size["first"]))
    starts = F.array(*map(F.lit, bounds)) if bounds else F.array().cast("array<double>")
    opens = (F.col("_run") > 0) & (F.col("_key") == F.element_at(starts, F.greatest(F.col("_run").cast("int"), F.lit(1)))) if bounds else F.lit(False)
    places = F.filter(
        F.array(
            F.struct(F.lit(0).alias("_guest"), F.col("_run").alias("_to")),
            F.when(opens, F.struct(F.lit(1).alias("_guest"), (F.col("_run") - 1).alias("_to"))),
            F.when(first, F.struct(F.lit(2).alias("_guest"), F.lit(last).alias("_to"))),
        ),
        lambda p: p.isNotNull(),
    )
    dealt = keyed.withColumn("_place", F.explode(places)).select("*", "_place.*").drop("_place", "_run", "_key")
    order = Window.partitionBy("_to").orderBy(
        (F.col("_guest") == 2).cast("int"), F.col(doc_id).desc_nulls_last(), F.xxhash64(*columns), *columns
    )
    led = dealt.select("*", *(F.lead(c).over(order).alias(f"next_{c}") for c in columns))
    return led.where("_guest = 0").drop("_guest", "_to")


def edited(text: str, following: str) -> Column:
    """``text`` with its last floor(n / 2) code points replaced by the first as many, or all, of ``following``."""
    return F.expr(f"""concat(substring({text}, 1, char_length({text}) - char_length({text}) div 2),
                      substring({following}, 1, cast(char_length({text}) div 2 as int)))""")


def compare_with_next(df: DataFrame) -> DataFrame:
    """Fingerprints of each document (``doc_id``, ``text``), of its text edited with
    the next document's, and their likeness; see :func:`with_next` for repeated
    and null ids. A null text is empty. Other columns are not read.
    """
    docs = df.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    own = fingerprint(docs, "text", "fingerprint").withColumn("fingerprint", F.unhex("fingerprint"))
    paired = with_next(own, ["text", "fingerprint"]).select(
        "doc_id", F.char_length("text").cast("bigint").alias("n_chars"), edited("text", "next_text").alias("edited"),
        F.lower(F.hex("fingerprint")).alias("fingerprint"), F.lower(F.hex("next_fingerprint")).alias("next_fingerprint"),
    )
    both = fingerprint(paired, "edited", "edited_fingerprint")
    return both.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "fingerprint", "edited_fingerprint",
        likeness("fingerprint", "edited_fingerprint").alias("near_edited"),
        likeness("fingerprint", "next_fingerprint").alias("near_next"),
    )
