"""Drop lines that many documents share (operator 8, DataFrame functions only).

Line hashes live in sorted runs on levels. Documents come in batches. The hashes of a batch
are counted, those already known to be frequent are merge-anti-joined away, and what is left
becomes a run of level 0. As soon as a level holds ``fanout`` runs they are merged
into one run of the next level; a hash that reaches the document threshold there is
settled and never counted again. A run is written in as many buckets as there are shuffle
partitions, sorted by hash, so a merge join of two runs moves nothing, and that of a batch
with the runs moves the batch's counts once. A hash is the MD5 of the line's key (128 bits), so
different lines do not meet in practice.

Cases: a null or empty text is one empty line, which has no key and stays. Each
row is a document of its own, also if its id is null or repeated. Line keys are
counted once per document. A very long text is cut into its lines in its row. An empty
table gives an empty table.
"""

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tickermood.llm.common import ascii_lower, bucketed, strip_spaces, unused
from tickermood.session import scratch_path

MIN_CHARS = 1
MIN_DOCS = 10
BATCHES = 4
FANOUT = 2


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_hash(line: Column, min_chars=MIN_CHARS) -> Column:
    """MD5 of the line's key as 16 bytes; null for a key that is too short."""
    key = ascii_lower(strip_spaces(line))
    return F.when(F.length(key) >= min_chars, F.unhex(F.md5(key)))


@dataclass
class LineRuns:
    """Levelled runs of ``(hash, n_docs)``, each a bucketed table in the shared storage."""

    spark: SparkSession
    min_docs: int = MIN_DOCS
    fanout: int = FANOUT
    levels: list[list[DataFrame]] = field(default_factory=list)
    settled: list[DataFrame] = field(default_factory=list)

    def _written(self, rows: DataFrame, name: str) -> DataFrame:
        return bucketed(rows, "hash", name, int(self.spark.conf.get("spark.sql.shuffle.partitions")))

    def unsettled(self, counts: DataFrame) -> DataFrame:
        """Counts of the hashes that no settled run holds, by merge joins."""
        for run in self.settled:
            counts = counts.join(run.hint("merge"), "hash", "left_anti")
        return counts.select("hash", "n_docs")

    def add(self, counts: DataFrame) -> None:
        """Take in the ``(hash, n_docs)`` counts of one batch."""
        self._place(self._written(self.unsettled(counts), "line-run"), 0)

    def _place(self, run: DataFrame, level: int) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) >= self.fanout:
            self._compact(level)

    def merged(self, runs: list[DataFrame]) -> DataFrame:
        """The sums of several runs, by merge joins."""
        first, *others = runs
        for other in others:
            other = other.select("hash", F.col("n_docs").alias("more"))
            n_docs = F.coalesce("n_docs", F.lit(0)) + F.coalesce("more", F.lit(0))
            first = first.join(other.hint("merge"), "hash", "full_outer").select("hash", n_docs.alias("n_docs"))
        return first

    def _compact(self, level: int) -> None:
        run = self._written(self.merged(self.levels[level]), "line-merge")
        self.levels[level] = []
        # Both parts are read from the one run that was written.
        self.settled.append(run.where(F.col("n_docs") >= self.min_docs).select("hash"))
        self._place(run.where(F.col("n_docs") < self.min_docs), level + 1)

    def frequent(self) -> DataFrame:
        """Hashes counted in at least ``min_docs`` documents, each once.

        A hash may be settled by one compaction and be counted again in a run that
        was written before it; the union is therefore made distinct.
        """
        found = list(self.settled)
        pending = [run for level in self.levels for run in level]
        if pending:
            found.append(self.merged(pending).where(F.col("n_docs") >= self.min_docs).select("hash"))
        if not found:
            return self.spark.createDataFrame([], "hash binary")
        whole = found[0]
        for some in found[1:]:
            whole = whole.union(some)
        return whole.distinct()


def batch_counts(found: DataFrame, batch: int) -> DataFrame:
    """``(hash, n_docs)`` of the documents of one batch."""
    return found.where(F.col("batch") == batch).groupBy("hash").agg(F.count(F.lit(1)).alias("n_docs"))


def dedup_lines(
    docs: DataFrame, min_docs=MIN_DOCS, min_chars=MIN_CHARS, batches=BATCHES, fanout=FANOUT, counts=False
) -> DataFrame:
    """``docs`` with frequent lines removed from ``text``; all other columns stay.

    With ``counts``, ``n_lines`` and ``n_dropped`` are added (in place of columns of
    that name). The text passes one shuffle, to meet the positions of
    its dropped lines; every other shuffle carries hashes only.
    """
    spark = docs.sparkSession
    if counts:
        docs = docs.drop("n_lines", "n_dropped")
    mark, gone = unused(docs.columns, "text_mark"), unused(docs.columns, "dropped_lines")
    row_id = unused(docs.columns, "row_doc_id")
    # Rows of one id and one text have one result, so they may share their hashes.
    keyed = F.coalesce(F.xxhash64("text"), F.lit(0))
    hashes = docs.select(
        F.col("doc_id").alias("id"),
        keyed.alias("mark"),
        F.transform(lines_of(F.col("text")), lambda line: line_hash(line, min_chars)).alias("each"),
    )
    # Position -1 stands for the document as a whole: once for each of its hashes.
    entries = F.concat(
        F.transform("each", lambda h, i: F.struct(i.alias("pos"), h.alias("hash"))),
        F.transform(F.array_distinct("each"), lambda h: F.struct(F.lit(-1).alias("pos"), h.alias("hash"))),
    )
    batch = F.when(F.col("pos") == -1, F.pmod(F.xxhash64("id"), F.lit(batches)).cast("int")).otherwise(-1)
    rows = hashes.select("id", "mark", F.inline(entries)).where(F.col("hash").isNotNull()).withColumn("batch", batch)
    path = scratch_path(spark, "line-hashes")
    rows.write.partitionBy("batch").parquet(path)
    found = spark.read.schema(rows.schema).parquet(path)
    runs = LineRuns(spark, min_docs, fanout)
    for at in range(batches):
        runs.add(batch_counts(found, at))
    dropped = (
        found.where(F.col("batch") == -1)
        .join(runs.frequent(), "hash", "left_semi")
        .groupBy(F.col("id").alias(row_id), F.col("mark").alias("row_mark"))
        .agg(F.collect_set("pos").alias(gone))
    )
    marked = docs.withColumn(mark, keyed)
    met = marked.join(
        dropped,
        marked["doc_id"].eqNullSafe(dropped[row_id]) & (marked[mark] == dropped["row_mark"]),
        "left",
    )
    all_lines = lines_of(F.col("text"))
    kept = F.array_except(F.sequence(F.lit(0), F.size(all_lines) - 1), F.col(gone))
    short = F.array_join(F.transform(kept, lambda i: F.get(all_lines, i)), "\n")
    has = F.col(gone).isNotNull()
    text = F.when(has, short).otherwise(F.col("text")).alias("text")
    added = [
        F.size(all_lines).cast("long").alias("n_lines"),
        F.when(has, F.size(gone)).otherwise(0).cast("long").alias("n_dropped"),
    ]
    return met.select(*[text if c == "text" else marked[c] for c in docs.columns], *(added if counts else []))
