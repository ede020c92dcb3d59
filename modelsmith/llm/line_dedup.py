"""Line dedup by a suffix array over line ids (operator 2, native).

The documents, in order of id, form one sequence of lines with a gap after each
document. Prefix doubling names, for k = 0, 1, 2, ..., the run of 2^k lines that
starts at each position: equal names for equal runs. Only positions whose run
occurs elsewhere go on to the next k, so the work shrinks with the repeats. The
names are then read back from the longest to the shortest: rows that share a run
and share the next 2^k lines move on together, which leaves one row, the first
occurrence, standing for the group. In the end the rows that stand together are
the intervals of the suffix array whose longest common prefix is their length:
the maximal repeated runs. All occurrences but the first are later copies, and
the lines of those with ``min_words`` words or more are deleted.

In other words: a line goes if it lies in a run of lines, within its document and
of ``min_words`` words in all, that also starts at an earlier place.

Definitions: lines are parted by a line feed, words by spaces. A null text stays
null; an empty text is one empty line. A text that loses every line becomes
empty, its row stays. Repeated rows and copies lose all lines if they have
``min_words`` words. Ties of id are taken in the order of the text's hash; the
order of equal rows does not show. An empty table gives no rows.

At scale: lines are moved as 128-bit hashes and numbers; texts are read twice and
shuffled once, for the last join. A line with very many copies is counted with
map-side partial sums, and joins by names are equi-joins that adaptive execution
splits where a name is hot. No group is ever collected; the list of a document's
kept segments is bounded by its lines. Each level is staged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from modelsmith.llm.prefix import prefix_sums
from modelsmith.llm.scratch import stage

MIN_WORDS = 50


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _n_words(line: Column) -> Column:
    bare = F.trim(line)
    return F.when(bare == "", 0).otherwise(F.size(F.split(bare, " +")))


def _renamed(rows: DataFrame, by: list[str]) -> DataFrame:
    """Adds ``name`` (the first position of the rows that agree in ``by``) and keeps those that occur twice or more."""
    # Staged, so that both sides of the join are shuffled for it alone and a hot name's rows can be split.
    names = stage(rows.groupBy(*by).agg(F.min("pos").alias("name"), F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n"), "names")
    return rows.join(names, by)


def name_runs(lines: DataFrame) -> list[DataFrame]:
    """``lines`` (pos, start of the document, h1, h2, words) -> for each k the repeated runs of 2^k lines: pos, name
    (their first position), words; the first level has the document's start too.

    Two positions have one name exactly if their runs are equal. A position that no line has ends a run."""
    levels = [stage(_renamed(lines, ["h1", "h2"]).select("pos", "start", "name", "words"), "runs")]
    while not levels[-1].isEmpty():
        width = 1 << (len(levels) - 1)
        then = levels[-1].select((F.col("pos") - width).alias("pos"), F.col("name").alias("next"), F.col("words").alias("_words"))
        joined = levels[-1].select("pos", "name", "words").join(then, "pos").select("pos", F.col("name").alias("head"), "next", (F.col("words") + F.col("_words")).alias("words"))
        levels.append(stage(_renamed(joined, ["head", "next"]).select("pos", "name", "words"), "runs"))
    return levels[:-1]


def repeated_runs(levels: list[DataFrame]) -> DataFrame:
    """pos, length, words of every later occurrence of a maximal repeated run (of each pos the longest alone counts).

    A row (pos, length, group) says: the run of ``length`` lines at pos is shared by the group's rows."""
    groups = None
    for k in range(len(levels) - 1, -1, -1):
        width, level = 1 << k, levels[k]
        # Runs that the next level did not take further start here, and one row for each group that it did.
        if k + 1 < len(levels):
            above = levels[k + 1].select("pos", (F.col("pos") == F.col("name")).alias("_first"))
            fresh = level.select("pos", "name", "words").join(above, "pos", "left").where(F.coalesce("_first", F.lit(True)))
        else:
            fresh = level.select("pos", "name", "words")
        moved = fresh.select("pos", F.lit(0).cast("long").alias("length"), F.lit(-1).cast("long").alias("group"), F.lit(0).cast("long").alias("words"),
                             "name", F.col("words").alias("more"))
        if groups is not None:
            on = level.select(F.col("pos").alias("_at"), "name", F.col("words").alias("more"))
            moved = moved.unionByName(groups.join(on, F.col("pos") + F.col("length") == F.col("_at"), "left").drop("_at"))
        moved = stage(moved, "groups")
        # Rows of one group whose next lines have one name go on together, if they are two at least.
        taken = stage(moved.where("name is not null").groupBy("length", "group", "name").agg(
            F.min("pos").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"), "taken")
        on = moved.where("name is not null").join(taken, ["length", "group", "name"], "left")
        # A new group is named by its first row and its length's place: no two groups of one length share a first row.
        gone = on.where("first is not null").select(
            "pos", (F.col("length") + width).alias("length"), F.col("first").alias("group"), (F.col("words") + F.col("more")).alias("words"))
        stays = on.where("first is null or first = pos").select("pos", "length", "group", "words")
        rest = moved.where("name is null").select("pos", "length", "group", "words")
        groups = stage(gone.unionByName(stays.where("length > 0")).unionByName(rest), "groups")
    first = stage(groups.groupBy("length", "group").agg(F.min("pos").alias("first")), "first")
    return groups.join(first, ["length", "group"]).where("pos > first").select("pos", "length", "words")


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with later copies of repeated line runs deleted from the text, and the columns ``n_lines`` and
    ``n_deleted``. Columns of ``docs`` by these two names are replaced; all others come back unchanged, whatever their names."""
    kept_columns = [c for c in docs.columns if c not in ("n_lines", "n_deleted")]
    # The row is packed, so that no column of it can clash with ours. Its own number joins the result to the text; it
    # depends on the input's files alone, and the hash proves it.
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in kept_columns]).alias("_in"))
    source = F.col("_in")[text_col]
    rows = rows.withColumn("_row", F.monotonically_increasing_id()).withColumn("_hash", F.xxhash64(source))
    own = [F.col("_in")[c].alias(c) for c in kept_columns]
    line = F.col("line")
    hashed = stage(rows.where(source.isNotNull()).select(
        F.col("_in")[id_col].alias("_id"), "_row", "_hash",
        F.transform(_lines(source), lambda x: F.struct(F.xxhash64(x).alias("h1"), F.xxhash64(F.lit(1), x).alias("h2"), _n_words(x).alias("words"))).alias("lines"),
    ), "lines")
    placed = stage(prefix_sums(hashed.select("_id", "_hash", "_row", (F.size("lines") + 1).cast("long").alias("_size")), ["_id", "_hash"], "_size").select(
        "_row", "_hash", F.col("before").alias("start")), "placed")
    lines = hashed.select("_row", F.posexplode("lines").alias("nth", "line")).join(placed.select("_row", "start"), "_row").select(
        (F.col("start") + F.col("nth")).alias("pos"), "start", line.h1.alias("h1"), line.h2.alias("h2"), line.words.cast("long").alias("words"))
    levels = name_runs(lines)
    if not levels:
        return rows.select(*own, F.size(_lines(source)).alias("n_lines"), F.when(source.isNotNull(), F.lit(0)).alias("n_deleted"))
    runs = repeated_runs(levels).where(F.col("words") >= min_words).groupBy("pos").agg(F.max("length").alias("length"))
    spans = runs.join(levels[0].select("pos", "start"), "pos").select("start", (F.col("pos") - F.col("start")).alias("first"), "length")
    by_doc = Window.partitionBy("start").orderBy("first")
    reach = F.max(F.col("first") + F.col("length")).over(by_doc.rowsBetween(Window.unboundedPreceding, -1))
    islands = spans.select("*", F.when(F.col("first") <= reach, 0).otherwise(1).alias("_new")).select(
        "*", F.sum("_new").over(by_doc).alias("_island")).groupBy("start", "_island").agg(
        F.min("first").alias("first"), F.max(F.col("first") + F.col("length")).alias("end"))
    cut = islands.groupBy("start").agg(F.sort_array(F.collect_list(F.struct("first", "end"))).alias("cut"))  # bounded by a document's lines
    edits = cut.join(placed, "start").select("_row", F.col("_hash").alias("_seen"), "cut")
    joined = rows.join(edits, "_row", "left")
    sound = F.assert_true(F.col("_seen").isNull() | (F.col("_seen") == F.col("_hash")), F.lit("the input's rows came in another order when read again"))
    text = F.when(F.col("cut").isNull() | sound.isNotNull(), source).otherwise(F.array_join(_without(_lines(source), F.col("cut")), "\n"))
    deleted = F.aggregate("cut", F.lit(0).cast("long"), lambda n, c: n + c.end - c.first)
    return joined.select(
        *[text.alias(c) if c == text_col else o for c, o in zip(kept_columns, own, strict=True)],
        F.size(_lines(source)).alias("n_lines"),
        F.when(source.isNotNull(), F.coalesce(deleted, F.lit(0)).cast("int")).alias("n_deleted"))


def _without(lines: Column, cut: Column) -> Column:
    """The lines between the cuts: one slice a gap, so the work is linear in the lines."""
    starts = F.concat(F.array(F.lit(0).cast("long")), F.transform(cut, lambda c: c.end))
    ends = F.concat(F.transform(cut, lambda c: c.first), F.array(F.size(lines).cast("long")))
    gaps = F.zip_with(starts, ends, lambda a, b: F.slice(lines, (a + 1).cast("int"), (b - a).cast("int")))
    return F.flatten(gaps)
