"""A log of batches in a shared folder.

Each attempt at a batch has a folder of its own, ``writer=<w>/batch_id=<n>/attempt=<a>``, and counts once a commit names it
(see ``sources.commits``).  A batch that is written again is replaced by one commit: readers see the old attempt until then,
and a replayed micro-batch leaves the log as it was.

Compaction folds batches into files sorted by key on two levels: a base, and a delta of what came after it.  A manifest
lists the files with their key bounds, so the key space is cut into the ranges of the base files.  Only ranges for which
enough new rows have come are rewritten, together with what the delta holds for them; new rows of other ranges go to the
delta, and untouched base files are carried on as they are.  The bounds also tell a lookup of few keys which files to open.
``vacuum`` removes what has been replaced.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowloom.plans.skew import fits_broadcast
from rowloom.sources.commits import Commits, State, batch_path, in_ranges

Fold = Callable[[DataFrame], DataFrame]

BATCH = ("writer", "batch_id")
DELTA, BASE = 1, 2
FEW_KEYS = 1000
RANGES = 1023  # base files that lie side by side share a range where there are more of them
TRIES = 5


class StaleFold(RuntimeError):
    """Another commit has replaced what a compaction read."""


@dataclass(frozen=True)
class Keys:
    """The few distinct keys that are asked for, all of them set, and the name of their column."""

    column: str
    values: tuple


def few_keys(requests: DataFrame, column: str, most: int = FEW_KEYS) -> Keys | None:
    """The keys of ``requests`` where there are at most ``most`` requests and the keys are texts or whole numbers."""
    if not isinstance(requests.schema[column].dataType, (T.StringType, T.IntegralType)):
        return None
    found = requests.select(column).limit(most + 1).collect()
    if len(found) > most:
        return None
    return Keys(column, tuple(sorted({r[0] for r in found if r[0] is not None})))


@dataclass(frozen=True)
class BatchLog:
    """Append, read and compact batches.  ``schema`` has the partition columns of ``routed`` among its fields.

    ``file_rows`` is the greatest number of rows of a folded file; without it files are as large as shuffle partitions.
    """

    spark: SparkSession
    root: str
    schema: T.StructType
    routed: Sequence[str] = ()
    sort_by: Sequence[str] = field(default_factory=tuple)
    file_rows: int | None = None
    commits: Commits = field(init=False, repr=False, compare=False)
    _files: dict[str, list] = field(default_factory=dict, repr=False, compare=False)

    def __post_init__(self):
        object.__setattr__(self, "commits", Commits(self.spark, f"{self.root}/commits"))

    @property
    def order(self) -> list[str]:
        return [*self.routed, *self.sort_by]

    def state(self) -> State:
        return self.commits.state()

    def batches(self) -> list[tuple[str, int]]:
        """The finished batches that no snapshot holds, as (writer, batch id)."""
        return sorted(self.state().open)

    def has(self, writer: str, batch_id: int) -> bool:
        """Whether a batch has been written, also when only a snapshot still holds it."""
        state = self.state()
        return (writer, batch_id) in state.open or in_ranges(state.covered, writer, batch_id)

    def snapshots(self) -> list[int]:
        """Numbers of the snapshots whose files are all there."""
        state = self.state()
        return [n for n, _ in state.replaced] + [state.number] * (state.fold is not None)

    def append(self, df: DataFrame, batch_id: int, writer: str = "main") -> None:
        """Write one batch, replacing an earlier attempt at it.

        A batch that a snapshot holds already cannot be written again, because nobody would read it.
        """

        def put(state: State) -> dict:
            if in_ranges(state.covered, writer, batch_id):
                raise ValueError(f"batch {batch_id} of {writer!r} is part of a snapshot and cannot be replaced")
            return {"put": [writer, batch_id, attempt]}

        attempt = f"a{uuid.uuid4().hex}"
        put(self.state())
        for f in self.schema:
            if df.schema[f.name].dataType.simpleString() != f.dataType.simpleString():
                raise TypeError(f"{f.name} is {df.schema[f.name].dataType}, but the log holds {f.dataType}")
        path = batch_path(writer, batch_id, attempt)
        self._save(df.select(*[f.name for f in self.schema]), path)
        try:
            self.commits.commit(put)
        except ValueError:
            self._delete(path)
            raise

    def _save(self, df: DataFrame, path: str) -> None:
        out = df.write
        if self.sort_by and isinstance(self.schema[self.sort_by[0]].dataType, (T.StringType, T.IntegralType)):
            out = out.option(f"parquet.bloom.filter.enabled#{self.sort_by[0]}", "true")
            out = out.option("parquet.bloom.filter.adaptive.enabled", "true")
        if self.file_rows and path.startswith("fold="):
            out = out.option("maxRecordsPerFile", self.file_rows)
        (out.partitionBy(*self.routed) if self.routed else out).parquet(f"{self.root}/{path}")

    def _delete(self, path: str) -> None:
        fs, place = self.commits.storage(f"{self.root}/{path}")
        fs.delete(place, True)

    @property
    def _stored(self) -> T.StructType:
        fields = [*self.schema, T.StructField("writer", T.StringType()), T.StructField("batch_id", T.LongType())]
        return T.StructType(fields)

    def _load(self, paths: Sequence[str]) -> DataFrame:
        schema = self._stored
        if not paths:
            return self.spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema])
        paths = self._gathered(paths)
        reader = self.spark.read.schema(schema).option("basePath", self.root)
        return reader.parquet(*[f"{self.root}/{p}" for p in paths]).select(*[f.name for f in schema])

    def _gathered(self, paths: Sequence[str]) -> list[str]:
        """The paths, or the folder of a level in place of its files where they are all of them; each path costs a call."""
        levels: dict[str, list[str]] = {}
        for path in paths:
            levels.setdefault("/".join(path.split("/")[:2]), []).append(path)
        found = []
        for level, own in levels.items():
            if len(own) > 1 and level.startswith("fold="):
                fs, place = self.commits.storage(f"{self.root}/{level}")
                marks = int(fs.exists(self.commits.storage(f"{self.root}/{level}/_SUCCESS")[1]))
                if fs.getContentSummary(place).getFileCount() - marks == len(own):
                    own = [level]
            found += own
        return found

    def manifest(self, fold: str) -> DataFrame:
        """The files of a snapshot: path, level, n_rows, bytes, and the lowest and highest key."""
        key = T.StructType([self._stored[n] for n in self.order] or [T.StructField("none", T.IntegerType())])
        kinds = {"path": T.StringType(), "level": T.IntegerType(), "n_rows": T.LongType(), "bytes": T.LongType(), "low": key, "high": key}
        schema = T.StructType([T.StructField(name, kind) for name, kind in kinds.items()])
        return self.spark.read.schema(schema).parquet(f"{self.root}/manifest={fold}")

    def _listed(self, fold: str) -> list[tuple[str, int, int]]:
        """Path, level and number of rows of all files; a manifest never changes, so it is read once."""
        if fold not in self._files:
            self._files.clear()
            self._files[fold] = [tuple(r) for r in self.manifest(fold).select("path", "level", "n_rows").collect()]
        return self._files[fold]

    def files(self, fold: str | None, level: int, keys: Keys | None = None) -> list[str]:
        """Paths of the files of one level, or of those that may hold one of some keys."""
        if fold is None:
            return []
        paths = [path for path, own, _ in self._listed(fold) if own == level]
        if keys is None or keys.column not in self.order:
            return paths
        low, high = F.col("low")[keys.column], F.col("high")[keys.column]
        if not keys.values:
            return []
        asked = F.array(*[F.lit(v) for v in keys.values])
        near = self.manifest(fold).where(F.col("level") == level)
        return [r.path for r in near.where(F.exists(asked, lambda k: (low <= k) & (k <= high))).select("path").collect()]

    def parts(self, skip: Iterable[tuple[str, int]] = (), keys: Keys | None = None,
              state: State | None = None) -> tuple[DataFrame | None, DataFrame | None]:
        """The latest base, and the delta with the finished batches in no snapshot, but for ``skip``; None where empty.

        With ``keys``, files that cannot hold one of them are not opened, and the rows of others are left out.
        """
        state = state or self.state()
        some = lambda rows: rows if keys is None else rows.where(F.col(keys.column).isin(*keys.values))
        wanted = sorted(set(state.open) - set(skip))
        base = fresh = None
        if state.fold is not None:
            base = some(self._load(self.files(state.fold, BASE, keys)))
        if wanted or base is None:
            fresh = some(self._load([batch_path(*b, state.open[b]) for b in wanted]))
        delta = self.files(state.fold, DELTA, keys)
        if delta:
            rows = some(self._load(delta))
            fresh = rows if fresh is None else rows.unionByName(fresh)
        return base, fresh

    def read(self, keys: Keys | None = None) -> DataFrame:
        """All rows that are to be folded."""
        base, fresh = self.parts(keys=keys)
        if base is None or fresh is None:
            return base if fresh is None else fresh
        return base.unionByName(fresh)

    def folded(self, fold: Fold, keys: Sequence[str], narrow: Fold = lambda rows: rows,
               skip: Iterable[tuple[str, int]] = (), only: Keys | None = None) -> DataFrame:
        """The fold by ``keys`` of the rows that ``narrow`` leaves, or of the rows of the keys ``only``.

        A base is folded already.  Where the batches after it are small, only the rows of their keys are folded with
        them and the rest of the snapshot is taken as it is, without a shuffle.
        """
        base, fresh = (None if part is None else narrow(part) for part in self.parts(skip, only))
        if base is None:
            return fold(fresh)
        if fresh is None:
            return base
        if only is not None:
            return fold(base.unionByName(fresh))
        touched = fresh.select(*[F.col(k).alias(f"__{k}") for k in keys])
        if not fits_broadcast(touched):
            return fold(base.unionByName(fresh))
        touched = touched.distinct()
        same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys])
        changed = fold(base.join(touched, same, "left_semi").unionByName(fresh))
        return base.join(touched, same, "left_anti").select(*changed.columns).unionByName(changed)

    def _bounds(self, fold: str) -> DataFrame:
        """One row with the ascending lower bounds of the ranges of the base: at most ``RANGES`` of them."""
        lows = self.manifest(fold).where(F.col("level") == BASE).select("low")
        every = F.ceil(F.size("lows") / RANGES)
        ranked = lows.agg(F.array_sort(F.collect_list("low")).alias("lows"))
        return ranked.select(F.filter("lows", lambda low, i: i % every == 0).alias("lows"))

    def _ranged(self, rows: DataFrame, key: Column, bounds: DataFrame, name: str = "__range") -> DataFrame:
        """Add the number of the range a key is in; keys below all bounds are in the first one."""
        rows, steps = rows.withColumn("__bounds", bounds.scalar()), F.array(*[F.lit((RANGES + 1) >> i) for i in range(1, RANGES.bit_length() + 1)])

        def halved(at: Column, step: Column) -> Column:
            return at + F.when(F.get("__bounds", at + step - 1) <= key, step).otherwise(0)

        return rows.withColumn(name, F.greatest(F.aggregate(steps, F.lit(0), halved), F.lit(1))).drop("__bounds")

    def _key(self) -> Column:
        return F.struct(*self.order)

    def compact(self, fold: Fold, keys: Sequence[str], keep: Column | None = None, keep_last: int = 1,
                full: bool | None = None, share: float = 0.25) -> int | None:
        """Fold all but the newest ``keep_last`` batches of each writer into a new snapshot and return its number.

        The newest batch of a writer may still be replayed with other content, so it stays a batch by default.  A range of
        the base is rewritten once the rows that came after it are ``share`` of its own; ``full`` says to rewrite all or
        none.  ``keep`` drops rows of a full fold for good.  Where another compaction or a replay comes first, this one
        begins again with what is left to do.
        """
        for _ in range(TRIES):
            try:
                return self._compact(fold, keys, keep, keep_last, full, share)
            except StaleFold:
                continue
        raise StaleFold(f"other commits came first {TRIES} times")

    def _compact(self, fold: Fold, keys: Sequence[str], keep: Column | None, keep_last: int, full: bool | None,
                 share: float) -> int | None:
        state = self.state()
        newest: dict[str, list[int]] = {}
        for writer, batch in sorted(state.open):
            newest.setdefault(writer, []).append(batch)
        late = {(w, b) for w, ids in newest.items() for b in ids[len(ids) - keep_last :]} if keep_last else set()
        took = sorted(set(state.open) - late)
        delta = self.files(state.fold, DELTA)
        if not took and not (full and delta) and not (keep is not None and state.fold is not None):
            return None
        base, fresh = self.parts(late, state=state)
        name = f"{state.number + 1}-{uuid.uuid4().hex[:12]}"
        kept: list[str] = []
        if base is None:
            self._write_level(fold(fresh), name, BASE, keep)
        elif full or keep is not None or not self.order:
            both = base if fresh is None else base.unionByName(fresh)
            self._write_level(fold(both), name, BASE, keep)
        else:
            kept = self._write_ranges(fold, fresh, state.fold, name, full, share)
        self._write_manifest(name, state.fold, kept)

        def said(now: State) -> dict:
            if now.fold != state.fold or any(now.open.get(b) != state.open[b] for b in took):
                raise StaleFold
            return {"fold": name, "took": [[*b, state.open[b]] for b in took]}

        try:
            return self.commits.commit(said).number
        except StaleFold:
            for path in (f"fold={name}", f"manifest={name}"):
                self._delete(path)
            raise

    def _write_ranges(self, fold: Fold, fresh: DataFrame, before: str, name: str, full: bool | None,
                      share: float) -> list[str]:
        """Rewrite the ranges that enough rows have come for, put other rows into the delta, and name the base files kept."""
        files = [(1, path, n_rows) for path, level, n_rows in self._listed(before) if level == BASE]
        if len(files) > 1:
            bounds = self._bounds(before)
            recent = self._ranged(fresh, self._key(), bounds)
            base = self._ranged(self.manifest(before).where(F.col("level") == BASE), F.col("low"), bounds)
            files = [tuple(r) for r in base.select("__range", "path", "n_rows").collect()]
        else:
            recent = fresh.withColumn("__range", F.lit(1))
        held: dict[int, int] = {}
        for number, _, n_rows in files:
            held[number] = held.get(number, 0) + n_rows
        came = {r["__range"]: r["n"] for r in recent.groupBy("__range").agg(F.count("*").alias("n")).collect()}
        due = [] if full is False else sorted(r for r, n in came.items() if n >= share * held.get(r, 0))
        late = sorted(set(came) - set(due))
        if due:
            old = self._load([path for number, path, _ in files if number in due])
            new = recent.where(F.col("__range").isin(due)).drop("__range")
            self._write_level(fold(old.unionByName(new)), name, BASE)
        if late:
            self._write_level(fold(recent.where(F.col("__range").isin(late)).drop("__range")), name, DELTA)
        return [path for number, path, _ in files if number not in due]

    def _write_level(self, folded: DataFrame, name: str, level: int, keep: Column | None = None) -> None:
        folded = folded if keep is None else folded.where(keep)
        if self.order:
            folded = folded.repartitionByRange(*self.order).sortWithinPartitions(*self.order)
        names = [c for c in (*[f.name for f in self.schema], *BATCH) if c in folded.columns]
        self._save(folded.select(*names), f"fold={name}/level={level}")

    def _write_manifest(self, name: str, before: str | None, kept: Sequence[str]) -> None:
        """List the files written for a snapshot, by their own metadata and keys, and those carried on from the one before."""
        found, fs = [], self.commits.storage(self.root)[0]
        levels = [level for level in (DELTA, BASE) if fs.exists(self.commits.storage(f"{self.root}/fold={name}/level={level}")[1])]
        for level in levels:
            rows = self.spark.read.schema(self._stored).option("basePath", self.root).parquet(f"{self.root}/fold={name}/level={level}")
            key = self._key() if self.order else F.struct(F.lit(0).alias("none"))
            own = rows.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("bytes"), key.alias("key"))
            found.append(own.groupBy("file", "bytes").agg(
                F.min("key").alias("low"), F.max("key").alias("high"), F.count("*").alias("n_rows")
            ).withColumn("level", F.lit(level)))
        columns = ("path", "level", "n_rows", "bytes", "low", "high")
        files = reduce(DataFrame.unionByName, found) if found else None
        if files is not None:
            file = F.url_decode(F.regexp_replace("file", "[+]", "%2B"))  # a URI, in which only a plus stands for itself
            path = F.concat(F.lit(f"fold={name}/"), F.substring_index(file, f"/fold={name}/", -1))
            files = files.withColumn("path", path).select(*columns)
        if kept:
            old = self.manifest(before).where(F.col("path").isin(list(kept))).select(*columns)
            files = old if files is None else old.unionByName(files)
        files.coalesce(1).write.parquet(f"{self.root}/manifest={name}")

    def vacuum(self) -> list[str]:
        """Delete replaced attempts, batches that a snapshot holds and files that it has replaced; returns their paths.

        Results that were read before the last compaction and are still to be computed lose their files.
        """
        state = self.state()
        used = {r.path for r in self.manifest(state.fold).select("path").collect()} if state.fold else set()
        gone = list(state.gone)
        for _, fold in state.replaced:
            gone += [r.path for r in self.manifest(fold).select("path").collect() if r.path not in used]
            gone.append(f"manifest={fold}")
        kept = {path.split("/")[0] for path in used}
        whole = lambda path: path.startswith("fold=") and path.split("/")[0] not in kept
        for path in dict.fromkeys(path.split("/")[0] if whole(path) else path for path in gone):
            self._delete(path)
        if gone:
            removed = [*state.gone, *(fold for _, fold in state.replaced)]
            self.commits.commit(lambda now: {"removed": removed})
        self.commits.forget()
        return [f"{self.root}/{path}" for path in gone]
