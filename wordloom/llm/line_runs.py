"""Line dedup: repeated runs of lines, found with a suffix array over line ids.

The lines of all documents are one sequence of ids per document. Prefix doubling sorts its
suffixes by their first 1, 2, 4, ... lines: a suffix's name at depth 2h is the pair of the names at
depth h of itself and of the suffix h lines further on, ranked. Only suffixes that still
share their prefix with another one go on, as the others have their place already; so a round moves as many
rows as there are repeated runs of that length, and the rounds end by themselves after the longest one.

Suffixes with the same name at a depth are an interval of the suffix array whose longest common prefix has at least
that many lines. Its first member, by document id, row and line, stays; the lines of the others are later copies.

Of every repeated run of one line or more that has `LEAST_WORDS` words over its lines the later copies go, and runs
with fewer are left alone, however many lines they have; blank lines count nothing. Such a run, maximal ones as
well, is the union of the least runs along it, those that have fewer words without their last or without their first line.
A least run of any length is named by two names at the largest power of two in it, one from its start and one up to its end.

Lines are what stands between two `\\n`, compared exactly (two independent hashes of 64 bits); blank ones
count. Null and empty texts have no lines. A run may repeat within a document, also with overlap: what starts
later goes. Rows that repeat a whole document are later copies of it. Documents with equal ids keep the order
of the table. Rows are numbered once, and written with their numbers before they are used twice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wordloom.llm.mixing import word_count
from wordloom.llm.stored import cut, kept_as_table

# Runs of fewer words are left alone.
LEAST_WORDS = 10

POSITION = ["row", "line"]


def _lines(text: Column) -> Column:
    return F.when(text != "", F.split(text, "\n", -1)).otherwise(F.array().cast("array<string>"))


def line_ids(rows: DataFrame) -> DataFrame:
    """-> (row, line, doc_id, id), `id` being 128 bits that stand for the line."""
    exploded = rows.select("row", "doc_id", F.posexplode("lines").alias("line", "text"))
    identity = F.struct(F.xxhash64("text").alias("a"), F.xxhash64(F.lit(1), "text").alias("b"))
    return exploded.select("row", "line", "doc_id", identity.alias("name"))


def _ranked(named: DataFrame, *more: str) -> DataFrame:
    """(row, line, doc_id, name, ...) -> the same for names that occur twice, `name` replaced by its rank.

    Ranks follow the order of the names but leave gaps. Counting comes first, so a name of any frequency is a row
    per task before it is one row; the join back spreads over tasks what has a frequent name.
    """
    first = F.min(F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id", "row", "line"))
    groups = named.groupBy("name").agg(F.count("*").alias("n"), first.alias("first")).where("n > 1")
    ranked = groups.orderBy("name").select("name", "first", F.monotonically_increasing_id().alias("rank"))
    found = named.join(ranked, "name")
    later = (F.col("row") != F.col("first.row")) | (F.col("line") != F.col("first.line"))
    return found.select("row", "line", "doc_id", F.col("rank").alias("name"), later.alias("later"), "first", *more)


def suffix_levels(lines: DataFrame) -> list[tuple[int, DataFrame]]:
    """Line ids -> [(depth, (row, line, doc_id, name, later, first))] for depth 1, 2, 4, ...

    `name` orders the suffixes that share `depth` lines or more with another one; `first` is where the first
    member of its interval stands, `later` whether this is another one. Ends when nothing is shared.
    """
    depth, level = 1, cut(_ranked(lines))
    levels = []
    while not level.isEmpty():
        levels.append((depth, level))
        ahead = level.select("row", (F.col("line") - depth).alias("line"), F.col("name").alias("next"))
        pairs = level.select(*POSITION, "doc_id", "name").join(ahead, POSITION)
        pair = F.struct(F.col("name").alias("a"), F.col("next").alias("b"))
        level = cut(_ranked(pairs.select(*POSITION, "doc_id", pair.alias("name"))))
        depth *= 2
    return levels


def least_runs(rows: DataFrame, least_words: int) -> DataFrame:
    """Numbered rows -> (row, doc_id, line, n): runs of n lines with so many words, and fewer without their last or first line.

    Windows hold what one document has: where each line starts, in words, beside the places that are so many words further on or back.
    """
    words = rows.select("row", "doc_id", F.posexplode(F.concat("lines", F.array(F.lit("")))).alias("line", "text"))
    words = words.select("row", "doc_id", "line", word_count(F.col("text")).alias("words"))
    before = Window.partitionBy("row").orderBy("line").rowsBetween(Window.unboundedPreceding, -1)
    starts = words.select("row", "doc_id", "line", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("at"))
    events = starts.select(
        "row",
        "doc_id",
        "line",
        F.explode(F.array(*[F.struct((F.col("at") + F.lit(k * least_words)).alias("at"), F.lit(k).alias("k")) for k in (-1, 0, 1)])).alias("e"),
    ).select("row", "doc_id", "line", "e.at", "e.k")
    line = F.when(F.col("k") == 0, F.col("line"))
    place = F.when(F.col("k") == 0, 0).otherwise(1)  # lines that start at the same word come before those who ask
    onward = Window.partitionBy("row").orderBy(F.desc("at"), place).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    back = Window.partitionBy("row").orderBy("at", place).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    events = events.select("row", "doc_id", "line", "k", F.min(line).over(onward).alias("stop"), F.max(line).over(back).alias("start"))
    begin = F.when(F.col("k") == 1, F.col("line")).when(F.col("k") == -1, F.col("start"))
    end = F.when(F.col("k") == 1, F.col("stop")).when(F.col("k") == -1, F.col("line"))
    return events.select("row", "doc_id", begin.alias("line"), (end - begin).alias("n")).where("n > 0").distinct()


def copies(rows: DataFrame, levels: list[tuple[int, DataFrame]], least_words: int = LEAST_WORDS) -> DataFrame:
    """-> (row, line, n): later copies of runs with so many words, which together cover all later copies of longer runs.

    Names are dealt by row once, as the runs are by their windows, so that both lookups meet without another exchange.
    """
    runs = least_runs(rows, least_words).withColumn("depth", F.expr("shiftleft(1, length(bin(n)) - 1)"))
    names = None
    for depth, level in levels:
        here = level.select(*POSITION, F.lit(depth).alias("depth"), "name")
        names = here if names is None else names.union(here)
    names = names.repartition("row")
    ends = names.select("row", F.col("line").alias("last"), "depth", F.col("name").alias("up_to"))
    runs = runs.join(names.hint("merge"), [*POSITION, "depth"]).withColumn("last", F.col("line") + F.col("n") - F.col("depth"))
    runs = runs.join(ends.hint("merge"), ["row", "last", "depth"])
    name = F.struct("n", F.col("name").alias("a"), F.col("up_to").alias("b"))
    return _ranked(runs.select(*POSITION, "doc_id", name.alias("name"), "n"), "n").where("later").select(*POSITION, "n")


def deletions(found: DataFrame) -> DataFrame:
    """Later copies of `copies` -> (row, spans), at most two spans per line of the document."""
    span = F.struct(F.col("line").alias("start"), (F.col("line") + F.col("n")).alias("stop"))
    return found.groupBy("row").agg(F.array_sort(F.collect_list(span)).alias("spans"))


NO_SPANS = "array<struct<start: int, stop: int>>"


def _kept() -> Column:
    """Lines outside all deleted runs: what lies between the end of one run and the start of the next.

    In order of their start runs are in order of their end as well, as none holds another one.
    """
    spans = F.coalesce("spans", F.array().cast(NO_SPANS))
    ends = F.concat(F.array(F.lit(0)), spans["stop"])
    begins = F.concat(spans["start"], F.array(F.size("lines")))
    gaps = F.zip_with(ends, begins, lambda e, b: F.slice("lines", e + 1, F.greatest(b - e, F.lit(0))))
    return F.flatten(gaps)


def _table(documents: DataFrame) -> DataFrame:
    """(text, doc_id, ...) -> (row, doc), `doc` being the row as a struct.

    The numbers are written with the rows: a second scan may be cut into other partitions, which number them otherwise.
    """
    return kept_as_table(documents.select(F.monotonically_increasing_id().alias("row"), F.struct("*").alias("doc")))


def _longest() -> Column:
    """The most consecutive lines that go; spans that touch are one."""

    def step(held: Column, span: Column) -> Column:
        start = F.when(span["start"] > held["stop"], span["start"]).otherwise(held["start"])
        return F.struct(start.alias("start"), span["stop"].alias("stop"), F.greatest(held["most"], span["stop"] - start).alias("most"))

    none = F.struct(F.lit(0).alias("start"), F.lit(0).alias("stop"), F.lit(0).alias("most"))
    return F.aggregate(F.coalesce("spans", F.array().cast(NO_SPANS)), none, step, lambda held: held["most"])


def without_copies(documents: DataFrame, least_words: int = LEAST_WORDS) -> DataFrame:
    """(text, doc_id, ...) -> (doc, kept_lines, n_lines, n_removed, longest_removed), `doc` being the row as a struct.

    Later copies of runs with so many words are gone; `longest_removed` is the most consecutive lines among them.
    """
    table = _table(documents)
    lines = _lines(F.col("doc.text")).alias("lines")
    rows = table.select("row", F.col("doc.doc_id").alias("doc_id"), lines)
    levels = suffix_levels(line_ids(rows))
    if levels:
        held = table.join(deletions(copies(rows, levels, least_words)), "row", "left")
    else:
        held = table.withColumn("spans", F.array().cast(NO_SPANS))
    # Texts are split after the join, which moves them once.
    held = held.select("doc", "spans", lines)
    n_lines = F.size("lines").cast("long").alias("n_lines")
    kept = held.select("doc", n_lines, _kept().alias("kept_lines"), _longest().cast("long").alias("longest_removed"))
    return kept.select("doc", "kept_lines", "n_lines", (F.col("n_lines") - F.size("kept_lines")).alias("n_removed"), "longest_removed")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without later copies of line runs that have `LEAST_WORDS` words; `n_chars` follows. A document that loses every line goes."""
    held = without_copies(docs).where("n_removed = 0 OR size(kept_lines) > 0")
    text = F.when(F.col("n_removed") == 0, F.col("doc.text")).otherwise(F.array_join("kept_lines", "\n"))
    held = held.withColumn("text", text)
    own = {"text": F.col("text"), "n_chars": F.length("text").cast("long")}
    return held.select(*[own.get(c, F.col(f"doc.`{c}`")).alias(c) for c in docs.columns])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op3: (doc_id, n_lines, n_removed, longest_removed, kept_sha256) for every row of `documents`."""
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    text = F.array_join("kept_lines", "\n")
    return without_copies(documents).select("doc.doc_id", "n_lines", "n_removed", "longest_removed", F.sha2(text, 256).alias("kept_sha256"))


SQL = r"""
WITH docs AS (
    SELECT row_number() OVER () AS row_no, doc_id,
        CASE WHEN text IS NULL OR text = '' THEN [] ELSE string_split(text, chr(10)) END AS lines
    FROM documents
), split AS (
    SELECT row_no, unnest(lines) AS line, unnest(range(1, len(lines) + 1)) AS i FROM docs
), counted AS (
    SELECT row_no, i, words, sum(words) OVER (PARTITION BY row_no ORDER BY i) AS after, after - words AS before
    FROM (SELECT row_no, i, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS words FROM split)
), full_lines AS (
    SELECT * FROM counted WHERE words > 0
), runs AS (
    SELECT a.row_no, a.i, b.i AS j
    FROM (SELECT *, before + 10 AS least FROM counted) a ASOF JOIN full_lines b ON a.row_no = b.row_no AND a.least <= b.after
    UNION
    SELECT b.row_no, a.i, b.i AS j
    FROM (SELECT *, after - 10 AS most FROM counted) b ASOF JOIN full_lines a ON a.row_no = b.row_no AND b.most >= a.before
), later AS (
    SELECT row_no, i, j
    FROM (SELECT row_no, i, j,
            row_number() OVER (PARTITION BY array_to_string(lines[i:j], chr(10)) ORDER BY doc_id NULLS FIRST, row_no, i) AS n
        FROM runs JOIN docs USING (row_no))
    WHERE n > 1
), gone AS (
    SELECT DISTINCT row_no, unnest(range(i, j + 1)) AS i FROM later
), kept AS (
    SELECT row_no, string_agg(line, chr(10) ORDER BY i) AS text, count(*) AS n
    FROM split ANTI JOIN gone USING (row_no, i)
    GROUP BY row_no
), longest AS (
    SELECT row_no, max(n) AS longest_removed
    FROM (SELECT row_no, count(*) AS n
        FROM (SELECT row_no, i - row_number() OVER (PARTITION BY row_no ORDER BY i) AS island FROM gone)
        GROUP BY row_no, island)
    GROUP BY row_no
)
SELECT doc_id, len(lines)::BIGINT AS n_lines, (len(lines) - coalesce(n, 0))::BIGINT AS n_removed,
    coalesce(longest_removed, 0)::BIGINT AS longest_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (row_no) LEFT JOIN longest USING (row_no)
"""
