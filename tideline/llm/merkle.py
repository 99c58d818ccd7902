"""Document fingerprints: Merkle trees over paragraphs and sections.

A section ends with an empty line, a paragraph with its line, and a paragraph
is cut into short runs of words behind a blank that follows a sign or one of
two frequent letters.
These boundaries depend on the characters beside them alone, so an edit
changes the runs it touches and their ancestors, and leaves all else as it
was. A run's hash is a leaf; each paragraph, section and the root hashes the
hashes below it. No character is left out, so roots are equal if and only if
texts are (up to collisions of the hashes).

The fingerprint is written as root:sections, sections parted by /, paragraphs
by . and leaves by nothing, six hexadecimal digits each. Two fingerprints are
compared without their texts: equal roots or branches need no look below, and
differing ones show where texts differ.

With DataFrame functions only. A document's next one is found within ranges
of ids: each range also receives a copy of the first row of the next range,
whose id is the cut between them, so texts are shuffled once and no task sees
all rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SECTIONS = r"(?<=\n\n)(?=[^\n])"
PARAGRAPHS = r"(?<=\n)(?=[^\n])"
RUNS = r"(?<=(?:[es]|[^\p{L}\p{N}])[ \t])(?=[^ \t])"
ROOT_DIGITS = 64
LEAF_DIGITS = 6


def tree(text: Column) -> Column:
    """Hashes of a text's leaves, by section and paragraph."""
    return F.transform(F.split(text, SECTIONS, -1), lambda s: F.transform(
        F.split(s, PARAGRAPHS, -1), lambda p: F.transform(F.split(p, RUNS, -1), lambda r: F.md5(r.cast("binary")))))


def fingerprint(leaves: Column) -> Column:
    """The fingerprint of a ``tree``."""
    node = lambda below: F.md5(F.array_join(below, "").cast("binary"))
    root = F.sha2(F.array_join(F.transform(leaves, lambda s: node(F.transform(s, node))), "").cast("binary"), 256)
    short = lambda p: F.array_join(F.transform(p, lambda r: F.substring(r, 1, LEAF_DIGITS)), "")
    listed = F.array_join(F.transform(leaves, lambda s: F.array_join(F.transform(s, short), ".")), "/")
    return F.concat_ws(":", root, listed)


def _below(fp: Column) -> Column:
    return F.substr(fp, F.lit(ROOT_DIGITS + 2), F.length(fp))


def _leaves(listed: Column) -> Column:
    return F.regexp_extract_all(listed, F.lit(f"[0-9a-f]{{{LEAF_DIGITS}}}"), F.lit(0))


def _common(x: Column, y: Column) -> Column:
    """2 common / (all of x + all of y) of two arrays of distinct elements."""
    return 2 * F.size(F.array_intersect(x, y)) / (F.size(x) + F.size(y))


def leaf_sets(fp: Column) -> Column:
    """Distinct leaves of a fingerprint, and distinct pairs of a leaf and its place in its paragraph."""
    placed = F.transform(F.split(_below(fp), "[./]"), lambda p: F.transform(
        _leaves(p), lambda leaf, i: F.concat_ws(" ", leaf, i)))
    return F.struct(F.array_distinct(_leaves(_below(fp))).alias("leaves"), F.array_distinct(F.flatten(placed)).alias("placed"))


def likeness(a: Column, b: Column, sets_a: Column | None = None, sets_b: Column | None = None) -> Column:
    """Share of common leaves of two fingerprints; 1 for equal roots.

    Leaves are common wherever they stand, once each; or leaves are common at
    the same place of a paragraph, so that repeated runs count as often as they
    stand. The larger of the two shares holds. ``leaf_sets`` of the
    fingerprints may be given where they are at hand.
    """
    x, y = (leaf_sets(fp) if s is None else s for fp, s in ((a, sets_a), (b, sets_b)))
    same = F.substring(a, 1, ROOT_DIGITS) == F.substring(b, 1, ROOT_DIGITS)
    return F.when(same, F.lit(1.0)).otherwise(F.greatest(
        _common(x["leaves"], y["leaves"]), _common(x["placed"], y["placed"])))


def _first_difference(a: Column, b: Column) -> Column:
    """Place (from 0) of the first elements of two arrays that differ, where one is missing too."""
    differ = F.zip_with(a, b, lambda x, y: ~x.eqNullSafe(y))
    return F.array_position(differ, F.lit(True)) - 1


def edit_place(a: Column, b: Column) -> Column:
    """(section, paragraph) of the first difference between two fingerprints, from 0; null if they are equal.

    Descends from the root into the first differing section and there to the
    first differing paragraph.
    """
    sections = [F.split(_below(fp), "/") for fp in (a, b)]
    at = _first_difference(*sections)
    inside = [F.split(F.coalesce(F.get(s, at.cast("int")), F.lit("")), r"\.") for s in sections]
    place = F.struct(at.alias("section"), F.greatest(F.lit(0).cast("long"), _first_difference(*inside)).alias("paragraph"))
    return F.when(F.substring(a, 1, ROOT_DIGITS) != F.substring(b, 1, ROOT_DIGITS), place)


def with_next(df: DataFrame, id_col: str, column: str, name: str, tie: str) -> DataFrame:
    """``df`` and, as ``name``, the ``column`` of the row with the next id (after the last: the first).

    Equal ids follow each other by ``tie``. A row without id has no next: null.
    """
    spark = df.sparkSession
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shares = [i / ranges for i in range(1, ranges)]
    wanted = [F.min(id_col)] + ([F.percentile_approx(id_col, shares, 100 * ranges)] if shares else [])
    row = df.filter(F.col(id_col).isNotNull()).agg(*wanted).first()
    cuts = sorted({row[0], *(row[1] if shares else [])}) if row[0] is not None else []

    # At most one cut for each shuffle partition. Range b begins with the row whose id is cut b.
    known = F.array(*[F.lit(c) for c in cuts]).cast(f"array<{df.schema[id_col].dataType.simpleString()}>")
    own = F.size(F.filter(known, lambda c: c <= F.col(id_col)))
    before = F.when(own == 1, F.lit(len(cuts))).otherwise(own - 1)
    place = lambda b, ghost, wrap: F.struct(b.alias("__b"), F.lit(ghost).alias("__ghost"), wrap.alias("__wrap"))
    itself, alone = place(own, False, F.lit(False)), -1 - F.pmod(F.xxhash64(tie), F.lit(ranges)).cast("int")
    places = (F.when(F.col(id_col).isNull(), F.array(place(alone, False, F.lit(False))))
              .when(F.array_contains(known, F.col(id_col)), F.array(itself, place(before, True, own == 1)))
              .otherwise(F.array(itself)))
    placed = df.select("*", F.inline(places))
    w = Window.partitionBy("__b").orderBy("__wrap", id_col, tie, "__ghost")
    led = placed.withColumn(name, F.lead(column).over(w))
    led = led.withColumn(name, F.when(F.col(id_col).isNotNull(), F.col(name)))
    return led.filter(~F.col("__ghost")).drop("__b", "__wrap", "__ghost")


def with_fingerprint(df: DataFrame, text: str, name: str) -> DataFrame:
    """``df`` and the fingerprint of a column's texts (null: as an empty one)."""
    rows = df.withColumn("__tree", tree(F.coalesce(F.col(text), F.lit(""))))
    return rows.withColumn(name, fingerprint(F.col("__tree"))).drop("__tree")


def edited_fingerprints(df: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of all rows and of their edited texts, and how alike they are.

    The edited text has the last quarter of its code points (floor) replaced
    by the first as many of the next row's text, or all of it. Columns: id,
    n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next, edit_section, edit_paragraph. Rows with equal ids follow each
    other by the hashes of their texts; a row without id has no next one, which
    counts as an empty text. An empty table gives an empty result.
    """
    docs = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = with_next(docs.withColumn("th", F.xxhash64("text")), "id", "text", "next", "th")
    n = F.char_length("text")
    cut = F.floor(n / 4)
    edited = F.concat(F.substr("text", F.lit(1), n - cut), F.substr(F.coalesce("next", F.lit("")), F.lit(1), cut))
    # The fingerprints are made behind the shuffle, which moves plain texts only.
    rows = rows.withColumn("edited", edited)
    for column, name in (("text", "own"), ("edited", "edited_fp"), ("next", "next_fp")):
        rows = with_fingerprint(rows, column, name).withColumn(f"{name}_sets", leaf_sets(F.col(name)))
    near = lambda other: likeness(F.col("own"), F.col(other), F.col("own_sets"), F.col(f"{other}_sets"))
    place = edit_place(F.col("own"), F.col("edited_fp"))
    return rows.select(
        F.col("id").alias(id_col), n.cast("long").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"), F.col("own").alias("fingerprint"),
        F.col("edited_fp").alias("edited_fingerprint"), near("edited_fp").alias("near_edited"), near("next_fp").alias("near_next"),
        place["section"].alias("edit_section"), place["paragraph"].alias("edit_paragraph"))
