"""Tables whose current files are named by a versioned list, so that a change of any number of partitions shows at once.

Each write goes to a folder of its own, ``commit=<name>/<column>=<value>/``, which no reader sees until it is published: the next
version of the list, a small text under ``_versions``, is moved into place without replacing another one. Whoever finds that
another writer was first, reads its list and tries again. A list has a line for each partition and commit, so its length is bounded
by the partitions and how often they are compacted, not by the number of writes. Old versions and the folders that no kept
version names are deleted by ``expire``.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

VERSIONS, COMMIT = "_versions", "commit"
#: Versions that stay readable, for readers that resolved one of them before the latest.
KEPT = 20
NULL = "__HIVE_DEFAULT_PARTITION__"


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _system(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    """Asked of the path's file system: a read that fails to find it would count as a failed query."""
    return _system(spark, path).exists(_path(spark, path))


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none where it does not exist."""
    if not path_exists(spark, path):
        return []
    return sorted(s.getPath().getName() for s in _system(spark, path).listStatus(_path(spark, path)))


def delete(spark: SparkSession, path: str) -> None:
    _system(spark, path).delete(_path(spark, path), True)


def touch(spark: SparkSession, path: str) -> None:
    """An empty file of that name."""
    _system(spark, path).create(_path(spark, path), True).close()


def read_text(spark: SparkSession, path: str) -> str:
    stream = _system(spark, path).open(_path(spark, path))
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_new(spark: SparkSession, path: str, text: str) -> bool:
    """Writes a small file whole or not at all; False where there is one of that name."""
    folder, name = path.rsplit("/", 1)
    draft = f"{folder}/.{name}-{uuid.uuid4().hex}"
    stream = _system(spark, draft).create(_path(spark, draft))
    stream.write(bytearray(text.encode()))
    stream.close()
    jvm = spark._jvm
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(_path(spark, draft).toUri(), spark._jsc.hadoopConfiguration())
    none = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        context.rename(context.makeQualified(_path(spark, draft)), context.makeQualified(_path(spark, path)), none)
    except Exception:
        delete(spark, draft)
        if path_exists(spark, path):
            return False
        raise
    return True


@dataclass(frozen=True)
class Snapshot:
    """One version: which commits hold each partition, how many partitions each commit has, and what batches have landed."""

    version: int = 0
    column: str = ""
    entries: frozenset[tuple[str, str]] = frozenset()
    sizes: dict[str, int] = field(default_factory=dict)
    #: For each numbered series of batches, the last number that is in the table.
    landed: dict[str, int] = field(default_factory=dict)

    def commits(self, partition: str) -> list[str]:
        return sorted(c for p, c in self.entries if p == partition)

    @property
    def partitions(self) -> list[str]:
        return sorted({p for p, _ in self.entries})

    def text(self) -> str:
        held = {"column": self.column, "sizes": self.sizes, "landed": self.landed, "entries": sorted(self.entries)}
        return json.dumps(held)


@dataclass(frozen=True)
class Staged:
    """Files that are written but not published."""

    path: str
    column: str
    commit: str
    partitions: tuple[str, ...]
    rows: int
    facts: dict


def is_snapshot_table(spark: SparkSession, path: str) -> bool:
    return path_exists(spark, f"{path}/{VERSIONS}")


def holds_rows(spark: SparkSession, path: str) -> bool:
    """Whether a folder has more than what is staged in it: published versions, or partitions as they were before there were any."""
    return is_snapshot_table(spark, path) or any(not n.startswith((f"{COMMIT}=", "_", ".")) for n in names_in(spark, path))


def current(spark: SparkSession, path: str) -> Snapshot:
    """The latest version; an empty one where nothing is published."""
    numbers = [int(n) for n in names_in(spark, f"{path}/{VERSIONS}") if n.isdigit()]
    if not numbers:
        return Snapshot()
    held = json.loads(read_text(spark, f"{path}/{VERSIONS}/{max(numbers):012d}"))
    entries = frozenset((p, c) for p, c in held["entries"])
    return Snapshot(max(numbers), held["column"], entries, held["sizes"], held["landed"])


def folders(path: str, snapshot: Snapshot, entries: Iterable[tuple[str, str]]) -> list[str]:
    """The fewest folders that hold just these entries: a commit's own one where all its partitions are wanted."""
    by_commit: dict[str, list[str]] = {}
    for partition, commit in entries:
        by_commit.setdefault(commit, []).append(partition)
    out = []
    for commit, partitions in sorted(by_commit.items()):
        whole = f"{path}/{COMMIT}={commit}"
        if len(partitions) == snapshot.sizes[commit]:
            out.append(whole)
        else:
            out += [f"{whole}/{snapshot.column}={p}" for p in sorted(partitions)]
    return out


def _scan(spark: SparkSession, path: str, schema: StructType | None, where: list[str]) -> DataFrame:
    if schema is None:
        return spark.read.option("basePath", path).parquet(*where).drop(COMMIT)
    if not where:
        return spark.createDataFrame([], schema)
    held = StructType([*schema.fields, StructField(COMMIT, StringType())])
    return spark.read.schema(held).option("basePath", path).parquet(*where).select(*schema.names)


def read_snapshot(
    spark: SparkSession, path: str, schema: StructType | None = None, wanted: Callable[[str], bool] | None = None
) -> DataFrame:
    """The rows of the latest version, with the files' own schema if none is given; ``wanted`` chooses partitions by their name,
    others are not even listed.
    """
    snapshot = current(spark, path)
    entries = [e for e in snapshot.entries if wanted is None or wanted(e[0])]
    return _scan(spark, path, schema, folders(path, snapshot, entries))


def read_staged(spark: SparkSession, staged: Staged, schema: StructType) -> DataFrame:
    where = [f"{staged.path}/{COMMIT}={staged.commit}"] if staged.partitions else []
    return _scan(spark, staged.path, schema, where)


def stage(
    df: DataFrame,
    path: str,
    column: str,
    order: Iterable[Column] = (),
    name: str | None = None,
    facts: dict[str, Column] | None = None,
    near: Column | None = None,
) -> Staged:
    """Write rows to a new commit, in one job that also counts them and takes ``facts``, aggregates over them.

    ``column`` decides the partition. Adaptive execution cuts a large one into several tasks and gathers small ones. Rows so narrow that it
    would not cut them are dealt by ``near`` as well, which tells parts of a partition apart. The same name again replaces what an earlier attempt
    staged under it.
    """
    spark, seen = df.sparkSession, Observation()
    commit = name or uuid.uuid4().hex
    df = df.hint("rebalance", column) if near is None else df.withColumn("_near", near).hint("rebalance", column, "_near").drop("_near")
    if order:
        df = df.sortWithinPartitions(column, *order)
    told = {"_rows": F.count(F.lit(1)), **(facts or {})}
    counted = df.observe(seen, *[expression.alias(fact) for fact, expression in told.items()])
    target = f"{path}/{COMMIT}={commit}"
    counted.write.mode("overwrite").partitionBy(column).parquet(target)
    found = dict(seen.get)
    partitions = [n.partition("=")[2] for n in names_in(spark, target) if n.startswith(f"{column}=")]
    return Staged(path, column, commit, tuple(partitions), found.pop("_rows"), found)


def discard(spark: SparkSession, staged: Staged) -> None:
    delete(spark, f"{staged.path}/{COMMIT}={staged.commit}")
    if not is_snapshot_table(spark, staged.path) and not names_in(spark, staged.path):
        delete(spark, staged.path)


def publish(
    spark: SparkSession,
    staged: Staged,
    partitions: Iterable[str] = (),
    entries: Iterable[tuple[str, str]] = (),
    series: tuple[str, int] | None = None,
) -> Snapshot:
    """Make a commit current, in place of all that ``partitions`` hold and of the given ``entries``, all at once.

    ``series`` names the numbered batch that the commit holds. A batch that has landed, be it merged with others since, is not
    published again.
    """
    gone = set(partitions)
    while True:
        before = current(spark, staged.path)
        if series and before.landed.get(series[0], -1) >= series[1]:
            return before
        kept = {e for e in before.entries if e[0] not in gone and e not in set(entries) and e[1] != staged.commit}
        added = {(p, staged.commit) for p in staged.partitions}
        sizes = {c: n for c, n in before.sizes.items() if any(e[1] == c for e in kept)}
        if added:
            sizes[staged.commit] = len(added)
        landed = before.landed | ({series[0]: series[1]} if series else {})
        after = replace(before, version=before.version + 1, column=staged.column, entries=frozenset(kept | added), sizes=sizes, landed=landed)
        if write_new(spark, f"{staged.path}/{VERSIONS}/{after.version:012d}", after.text()):
            return after


def compact(
    spark: SparkSession,
    path: str,
    schema: StructType,
    order: Iterable[Column] = (),
    most: int = 8,
    wanted: Iterable[str] | None = None,
    merge: Callable[[DataFrame], DataFrame] | None = None,
) -> int:
    """Merge the commits of each partition (of ``wanted``) that more than ``most`` hold; returns how many were merged away.

    Rows stay as they are, unless ``merge`` says what is left of them. Commits that are published meanwhile stay beside the merged one.
    """
    snapshot = current(spark, path)
    chosen = snapshot.partitions if wanted is None else set(wanted) & set(snapshot.partitions)
    large = {p for p in chosen if len(snapshot.commits(p)) > most}
    merged = {e for e in snapshot.entries if e[0] in large}
    if not merged:
        return 0
    rows = _scan(spark, path, schema, folders(path, snapshot, merged))
    rows = merge(rows) if merge else rows
    publish(spark, stage(rows, path, snapshot.column, order), entries=merged)
    return len(merged) - len(large)


def expire(spark: SparkSession, path: str, kept: int = KEPT) -> int:
    """Delete all but the last versions, and commits that none of those names; returns how many commits went.

    For a moment without a writer: what is staged and not yet published goes as well.
    """
    numbers = sorted(int(n) for n in names_in(spark, f"{path}/{VERSIONS}") if n.isdigit())
    needed: set[str] = set()
    for number in numbers[-kept:]:
        held = json.loads(read_text(spark, f"{path}/{VERSIONS}/{number:012d}"))
        needed |= {c for _, c in held["entries"]}
    for number in numbers[:-kept]:
        delete(spark, f"{path}/{VERSIONS}/{number:012d}")
    gone = [n for n in names_in(spark, path) if n.startswith(f"{COMMIT}=") and n.partition("=")[2] not in needed]
    for name in gone:
        delete(spark, f"{path}/{name}")
    return len(gone)
