"""Document fingerprints by winnowing, in DataFrame functions only.

Words are lower-cased runs of letters and digits. Each window of ``K`` words
gets a rolling hash: hashes of two words are combined into four, and four and
one into five, each step reusing all hashes of the step before. Of every
``WINDOW`` consecutive hashes the smallest is selected, the rightmost one if
several are equal. Selected hashes are kept with the position of their first
word. Hence any run of ``WINDOW + K - 1`` equal words in two texts selects at
least one common hash, and no run shorter than ``K`` words ever does.

Hash and position are packed into one long, 33 bits of hash above 31 bits of
reversed position, so the minimum of a window is at once its rightmost smallest
hash and where that lies. Window minima are taken by doubling.

Defined cases: a null text is empty; a text without words has the fingerprint
'' and the likeness of two such texts is 1, of one such text and another 0; a
text of fewer than ``K`` words has one hash, of all its words; fewer than
``WINDOW`` hashes form one window; rows with equal ids follow each other in the
order of a hash of their texts; rows with a null id come last. Columns other
than the id and the text are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridloom.operators.ordered import row_index
from gridloom.sources.scratch import materialise

K, WINDOW = 5, 8
#: Consecutive ids that share a tile when documents are paired with their neighbours.
TILE = 256

_PLACE_BITS = 31
_LAST_PLACE = (1 << _PLACE_BITS) - 1


def _with_later(values: Column, later: Column, by: int, combine: Callable[[Column, Column], Column]) -> Column:
    """``combine(values[i], later[i + by])``; past the end of ``later`` it gets a null."""
    moved = F.slice(later, by + 1, F.greatest(F.size(later) - by, F.lit(0)))
    return F.zip_with(values, moved, combine)


def winnow(df: DataFrame, text: str, out: str) -> DataFrame:
    """Add ``out``: packed selected hashes of the column ``text``, in order of position.

    Each step is a projection of its own, so nothing is computed twice.
    """
    step = {n: f"__{out}_{n}" for n in ("words", "one", "two", "four", "all")}

    def pair(a: Column, b: Column) -> Column:
        return F.xxhash64(a, b)

    def smaller(a: Column, b: Column) -> Column:
        return F.least(a, b)  # a null, past the end, is passed over

    spaced = F.trim(F.regexp_replace(F.lower(F.coalesce(F.col(text), F.lit(""))), r"[^\p{L}\p{N}]+", " "))
    df = df.withColumn(step["words"], F.when(spaced != "", F.split(spaced, " ")).otherwise(F.array().cast("array<string>")))
    df = df.withColumn(step["one"], F.transform(step["words"], lambda w: F.xxhash64(w)))
    one = F.col(step["one"])
    df = df.withColumn(step["two"], _with_later(one, one, 1, pair))
    two = F.col(step["two"])
    df = df.withColumn(step["four"], _with_later(two, two, 2, pair))
    df = df.withColumn(step["all"], _with_later(F.col(step["four"]), one, K - 1, pair))
    # The last K - 1 hashes lack words; a shorter text keeps its first one, which holds all its words.
    whole = F.slice(step["all"], 1, F.greatest(F.size(one) - (K - 1), F.least(F.size(one), F.lit(1))))
    packed = F.transform(
        whole, lambda h, i: F.shiftleft(F.shiftright(h, _PLACE_BITS), _PLACE_BITS).bitwiseOR(F.lit(_LAST_PLACE) - i)
    )
    df = df.withColumn(out, packed).drop(*step.values())
    hashes = F.col(out)
    df = df.withColumn(f"__{out}_n", F.size(out))
    for width in (1, 2, 4):  # minima of 2, 4 and 8 hashes
        df = df.withColumn(out, _with_later(hashes, hashes, width, smaller))
    windows = F.greatest(F.col(f"__{out}_n") - (WINDOW - 1), F.least(F.col(f"__{out}_n"), F.lit(1)))
    return df.withColumn(out, F.array_distinct(F.slice(out, 1, windows))).drop(f"__{out}_n")


def hash_set(packed: Column) -> Column:
    return F.array_distinct(F.transform(packed, lambda p: F.shiftright(p, _PLACE_BITS)))


def as_text(packed: Column) -> Column:
    """'position:hash' of every selected hash, by commas."""

    def entry(p: Column) -> Column:
        place = F.lit(_LAST_PLACE) - p.bitwiseAND(F.lit(_LAST_PLACE))
        return F.concat(place.cast("string"), F.lit(":"), F.hex(F.shiftrightunsigned(p, _PLACE_BITS)))

    return F.array_join(F.transform(packed, entry), ",")


def likeness(a: Column, b: Column) -> Column:
    """Jaccard likeness of two hash sets; 1 if both are empty."""
    shared = F.size(F.array_intersect(a, b))
    either = F.size(a) + F.size(b) - shared
    return F.when(either == 0, F.lit(1.0)).otherwise(shared / either)


def fingerprints(documents: DataFrame) -> DataFrame:
    """(doc_id, fingerprint, hashes, positions), one row per row of ``documents``."""
    marked = winnow(documents.select("doc_id", "text"), "text", "marks")
    return marked.select(
        "doc_id",
        as_text(F.col("marks")).alias("fingerprint"),
        F.transform("marks", lambda p: F.shiftright(p, _PLACE_BITS)).alias("hashes"),
        F.transform("marks", lambda p: (F.lit(_LAST_PLACE) - p.bitwiseAND(F.lit(_LAST_PLACE))).cast("int")).alias("positions"),
    )


def with_next(documents: DataFrame, prepare: Callable[[DataFrame], DataFrame], carried: list[str]) -> DataFrame:
    """Rows in descending order of doc_id, each with its follower's ``carried`` columns as ``next_*``.

    Documents are shuffled once, by tiles of ``TILE`` consecutive ids, and
    prepared there. A tile also gets a copy of the first row of the tile that
    follows it - the first tile follows the last one - so that no row looks
    outside its tile. What is ordered globally is one row per tile.
    """
    tile = F.coalesce(F.floor(F.col("doc_id") / F.lit(TILE)).cast("long"), F.lit(-(1 << 62)))
    table = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    tiles = table.groupBy(tile.alias("tile")).agg(F.max("doc_id").alias("top"))
    placed = materialise(row_index(tiles, [F.desc("tile")], "place"))
    n = max(placed.count(), 1)
    before = placed.select("tile", F.col("place").alias("at"))
    after = placed.select(F.col("top").alias("guest_id"), F.pmod(F.col("place") - 1, F.lit(n)).alias("at"))
    links = materialise(before.join(after, "at").select("tile", "guest_id"))
    own = table.select(tile.alias("tile"), F.lit(0).alias("guest"), "doc_id", "text")
    guests = table.join(links, F.col("doc_id").eqNullSafe(F.col("guest_id"))).select("tile", F.lit(1).alias("guest"), "doc_id", "text")
    ready = prepare(own.unionByName(guests).repartition("tile"))
    order = Window.partitionBy("tile").orderBy("guest", F.desc_nulls_last("doc_id"), F.xxhash64("text"))
    return ready.withColumns({f"next_{c}": F.lead(c).over(order) for c in carried}).filter("guest = 0").drop("tile", "guest")


def edit_fingerprints(documents: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited form, and their likeness to each other and to the next text's.

    The edited form has its last floor(n / 2) code points replaced by the first
    as many (or all) of the next document's.
    """

    def prepare(rows: DataFrame) -> DataFrame:
        rows = winnow(rows.withColumn("n_chars", F.length("text").cast("long")), "text", "marks")
        return rows.withColumn("hashes", hash_set(F.col("marks")))

    paired = with_next(documents, prepare, ["text", "hashes"])
    half = F.floor(F.col("n_chars") / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), F.col("n_chars").cast("int") - half), F.substring("next_text", F.lit(1), half))
    paired = paired.withColumn("edited", edited).drop("text", "next_text")
    marked = winnow(paired, "edited", "edited_marks")
    return marked.select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("edited"), 256).alias("edited_sha256"),
        as_text(F.col("marks")).alias("fingerprint"),
        as_text(F.col("edited_marks")).alias("edited_fingerprint"),
        likeness(F.col("hashes"), hash_set(F.col("edited_marks"))).alias("near_edited"),
        likeness(F.col("hashes"), F.col("next_hashes")).alias("near_next"),
    )
