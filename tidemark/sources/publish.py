"""Writing datasets so that readers see the old state or the new, never a mix.

A published dataset is a folder with written versions and one small file that
says which version holds which part. Keyed datasets are cut into buckets by key
hash, so an upsert rewrites only the buckets its keys fall in; or it writes its own
rows only, as a delta that readers merge, until the dataset is compacted. Buckets
split one after the other as the dataset grows.
"""

from __future__ import annotations

import json
import re
import uuid
import warnings
from collections.abc import Sequence
from dataclasses import asdict, dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tidemark.functions.names import exactly
from tidemark.operators.changes import latest_per_key, upsert_rows
from tidemark.operators.relational import join_anti, join_semi
from tidemark.operators.schema import columns_of, schema_changes
from tidemark.sources import storage
from tidemark.sources.csvformat import write_options

BUCKET = "_bucket"
DEFAULT_BUCKETS = 16
PART_KILOBYTES = 10000.0 * 3
# Bytes a bucket should hold on average, about.
BUCKET_BYTES = 1 << 30
# A dataset is due for compaction with so many deltas, or when they hold such a share of its bytes.
MOST_DELTAS = 20
DELTA_SHARE = 0.25
# Revision that wrote a delta's row.
WRITTEN = "_written"
# Seconds after which a writer that has claimed a revision but not published it is taken for dead.
CLAIM_SECONDS = 300.0
# Fewer sampled rows than this do not tell the row width.
SAMPLED_ROWS = 1000


@dataclass(frozen=True)
class State:
    """What a published folder holds: parts (bucket to version) and their schema.

    ``deltas`` are versions that hold later rows of keys, oldest first; with a ``delta_order`` the
    later row of a key by those columns wins, else the one written last. ``first_buckets`` (0: all) is the
    number of buckets before any split.
    """

    schema: str
    parts: dict[str, str] = field(default_factory=dict)
    keys: list[str] = field(default_factory=list)
    buckets: int = 0
    batches: dict[str, int] = field(default_factory=dict)
    revision: int = 0
    previous: int = 0
    deltas: list[str] = field(default_factory=list)
    delta_order: list[str] | None = None
    first_buckets: int = 0

    @property
    def versions(self) -> set[str]:
        return {*self.parts.values(), *self.deltas}


@dataclass(frozen=True)
class Upload:
    """A written version that no reader sees yet."""

    path: str
    version: str
    state: State
    rows: int


class ConflictError(RuntimeError):
    """Someone else published to the dataset in the meantime."""


# -- CSV parts -------------------------------------------------------------------


def estimate_part_rows(
    df: DataFrame, target_kb: float = PART_KILOBYTES, sample_fraction: float | None = 0.01
) -> int:
    """Rows per part so that a part holds about ``target_kb`` kilobytes of text.

    Takes the mean row width of a sample, or of all rows when the sample is
    small or ``sample_fraction`` is None. It only sets where parts are cut.
    """
    width = (F.octet_length(F.to_csv(F.struct(*exactly(df.columns)))) + 1) / 1000.0
    totals = [F.count(F.lit(1)).alias("rows"), F.avg(width).alias("kb")]
    found = df.sample(sample_fraction, seed=1).agg(*totals).first() if sample_fraction else None
    if found is None or found["rows"] < SAMPLED_ROWS:
        found = df.agg(*totals).first()
    return max(1, int(target_kb / found["kb"])) if found["rows"] else 0


def write_csv_parts(
    df: DataFrame, path: str, rows_per_part: int | None = None, sample_fraction: float | None = 0.01
) -> None:
    """Gzip CSV without header, ``\\N`` for missing, in parts of bounded size.

    Every task writes its own parts; an empty table gives an empty dataset.
    """
    if rows_per_part is None:
        rows_per_part = estimate_part_rows(df, sample_fraction=sample_fraction)
    (
        df.write.options(**write_options())
        .option("compression", "gzip")
        .option("maxRecordsPerFile", rows_per_part)
        .csv(path)
    )


# -- state -------------------------------------------------------------------------


STATE_FILE = re.compile(r"state-(\d{12})\.json")


def _state_file(path: str, revision: int) -> str:
    return f"{path.rstrip('/')}/state-{revision:012d}.json"


def _revisions(spark: SparkSession, path: str) -> list[int]:
    """Revisions there are state files of, the newest first."""
    found = (STATE_FILE.fullmatch(n) for n in storage.children(spark, path))
    return sorted((int(m[1]) for m in found if m), reverse=True)


def _state_of(spark: SparkSession, path: str, revision: int) -> State | None:
    """None where the file is not written to its end."""
    try:
        return State(**json.loads(storage.read_text(spark, _state_file(path, revision))))
    except json.JSONDecodeError:
        return None


def read_state(spark: SparkSession, path: str) -> State | None:
    """The newest state; each revision has a file of its own, which never changes."""
    for revision in _revisions(spark, path):
        state = _state_of(spark, path, revision)
        if state is not None:
            return state
    return None


def read_published(spark: SparkSession, path: str, state: State | None = None) -> DataFrame:
    """The dataset as it is, or as a ``state`` read before has it."""
    state = state or read_state(spark, path)
    if state is None:
        raise FileNotFoundError(f"nothing published at {path}")
    return _merged(_read_parts(spark, path, state), _read_deltas(spark, path, state), state)


def _read_deltas(spark: SparkSession, path: str, state: State) -> DataFrame | None:
    """The rows of all deltas, the last of each key, with the revision that wrote it; None without deltas."""
    if not state.deltas:
        return None
    schema = T.StructType.fromJson(json.loads(state.schema)).add(WRITTEN, T.LongType())
    rows = spark.read.schema(schema).parquet(*[_part_folder(path, v, "") for v in state.deltas])
    if state.delta_order is None:
        return latest_per_key(rows, state.keys, [WRITTEN])
    # Of rows that are alike in the order, the one written first stays.
    early = rows.withColumn(WRITTEN, -F.col(WRITTEN))
    return latest_per_key(early, state.keys, [*state.delta_order, WRITTEN])


def _merged(base: DataFrame, deltas: DataFrame | None, state: State) -> DataFrame:
    """Published parts with the deltas' rows in place of those of the same keys. The deltas are the
    small side: only their keys are looked for in the parts."""
    if deltas is None:
        return base
    late = deltas.drop(WRITTEN)
    if state.delta_order is None:
        return upsert_rows(base, late, state.keys)
    contested = join_semi(base, late, state.keys).withColumn(WRITTEN, F.lit(1)).unionByName(late.withColumn(WRITTEN, F.lit(0)))
    return join_anti(base, late, state.keys).unionByName(
        latest_per_key(contested, state.keys, [*state.delta_order, WRITTEN]).drop(WRITTEN)
    )


def _read_parts(
    spark: SparkSession, path: str, state: State, buckets: Sequence[str] | None = None
) -> DataFrame:
    schema = T.StructType.fromJson(json.loads(state.schema))
    wanted = state.parts if buckets is None else {b: v for b, v in state.parts.items() if b in buckets}
    folders = [_part_folder(path, version, bucket) for bucket, version in wanted.items()]
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*folders)


def part_folders(path: str, state: State) -> list[str]:
    """The folders that hold a state's parts."""
    return [_part_folder(path, version, bucket) for bucket, version in state.parts.items()]


def _part_folder(path: str, version: str, bucket: str) -> str:
    folder = f"{path.rstrip('/')}/versions/{version}"
    return f"{folder}/{BUCKET}={bucket}" if bucket else folder


def _bucket(keys: Sequence[str], buckets: int, first: int = 0) -> Column:
    """A key's bucket of ``buckets``, of which ``first`` were there before any split.

    Buckets split in turn, each in two: with ``level`` buckets before the round, those from ``level`` on are the
    second halves of the buckets from 0 on.
    """
    level = _level(buckets, first)
    hashed = F.xxhash64(*exactly(keys))
    half = F.pmod(hashed, F.lit(level))
    if buckets == level:
        return half.cast("int")
    return F.when(half < buckets - level, F.pmod(hashed, F.lit(2 * level))).otherwise(half).cast("int")


def _level(buckets: int, first: int) -> int:
    level = first or buckets
    while 2 * level <= buckets:
        level *= 2
    return level


def _parents(before: int, after: int, first: int) -> set[int]:
    """The buckets among the first ``before`` whose rows move when there are ``after``."""
    found = set()
    for bucket in range(before, after):
        while bucket >= before:
            bucket -= _level(bucket, first)
        found.add(bucket)
    return found


def check_keys(keys: Sequence[str] | None) -> list[str]:
    """Keys of an upsert must be given, and be text without gaps."""
    if isinstance(keys, str) or not keys or not all(isinstance(k, str) and k for k in keys):
        raise ValueError("an upsert needs the names of its key columns")
    return list(keys)


# -- upload, commit, abort -----------------------------------------------------------


def start_upload(
    df: DataFrame,
    path: str,
    keys: Sequence[str] = (),
    buckets: int = DEFAULT_BUCKETS,
    expected_rows: int | None = None,
    expected_revision: int | None = None,
) -> Upload:
    """Write a full new version next to what readers see.

    ``expected_revision`` is that of the state the rows were made from (0: nothing
    published); the commit is refused if the dataset has another one by then.
    """
    spark = df.sparkSession
    before = read_state(spark, path)
    if expected_revision is not None and (before.revision if before else 0) != expected_revision:
        raise ConflictError(f"{path} was changed by another writer")
    version = uuid.uuid4().hex
    state = State(
        schema=df.schema.json(),
        keys=list(keys),
        buckets=buckets if keys else 0,
        revision=_next_revision(spark, path),
        previous=before.revision if before else 0,
        batches=before.batches if before else {},
    )
    return _write(df, path, version, state, expected_rows)


def _write(df: DataFrame, path: str, version: str, state: State, expected_rows: int | None = None) -> Upload:
    spark = df.sparkSession
    folder = f"{path.rstrip('/')}/versions/{version}"
    try:
        if state.keys:
            # Rebalancing gathers a bucket's rows for few files, and splits a
            # bucket that one repeated key has made too large.
            bucketed = df.withColumn(BUCKET, _bucket(state.keys, state.buckets, state.first_buckets))
            bucketed.hint("rebalance", BUCKET).write.partitionBy(BUCKET).parquet(folder)
            names = [n for n in storage.children(spark, folder) if n.startswith(BUCKET + "=")]
            written = {n.split("=", 1)[1]: version for n in names}
        else:
            df.write.parquet(folder)
            written = {"": version}
        schema = T.StructType.fromJson(json.loads(state.schema))
        folders = [_part_folder(path, v, b) for b, v in written.items()]
        rows = spark.read.schema(schema).parquet(*folders).count() if folders else 0
        if expected_rows is not None and rows != expected_rows:
            raise RuntimeError(f"{rows} rows written, {expected_rows} expected")
    except BaseException:
        storage.remove(spark, folder)
        raise
    return Upload(path, version, replace(state, parts=state.parts | written), rows)


def _next_revision(spark: SparkSession, path: str) -> int:
    """Beyond every state file, also one that is not written to its end."""
    return max(_revisions(spark, path), default=0) + 1


def commit_upload(spark: SparkSession, upload: Upload) -> State:
    """Let readers see the upload, unless the dataset changed since it started."""
    gone = [f for b, v in upload.state.parts.items() if not storage.exists(spark, f := _part_folder(upload.path, v, b))]
    gone += [f for v in upload.state.deltas if not storage.exists(spark, f := _part_folder(upload.path, v, ""))]
    if gone:
        raise ConflictError(f"parts of the upload to {upload.path} were deleted: {gone[:3]}")
    now = read_state(spark, upload.path)
    if (now.revision if now else 0) != upload.state.previous or not _publish_state(spark, upload):
        abort_upload(spark, upload)
        raise ConflictError(f"{upload.path} was changed by another writer")
    return upload.state


def _publish_state(spark: SparkSession, upload: Upload) -> bool:
    """Write the state aside, claim its revision, then move it into place: readers never meet half a
    file, and one writer gets the revision. A claim whose writer has not published within
    CLAIM_SECONDS is taken over."""
    root = upload.path.rstrip("/")
    target = _state_file(root, upload.state.revision)
    if storage.exists(spark, target):
        return False
    text = json.dumps(asdict(upload.state))
    aside = f"{root}/staged/state-{uuid.uuid4().hex}.json"
    storage.create_text(spark, aside, text)
    try:
        for attempt in range(1000):
            claim = f"{root}/claims/{upload.state.revision:012d}-{attempt:03d}"
            if storage.create_text(spark, claim, upload.version):
                break
            if storage.exists(spark, target) or storage.age(spark, claim) < CLAIM_SECONDS:
                return False
        if storage.exists(spark, target) or not storage.rename(spark, aside, target):
            return False
        return storage.read_text(spark, target) == text
    finally:
        storage.remove(spark, aside)


def abort_upload(spark: SparkSession, upload: Upload) -> None:
    """Forget an upload; readers keep seeing what they saw."""
    storage.remove(spark, f"{upload.path.rstrip('/')}/versions/{upload.version}")


# -- publish -------------------------------------------------------------------------


def publish_replace(
    df: DataFrame,
    path: str,
    keys: Sequence[str] = (),
    buckets: int = DEFAULT_BUCKETS,
    expected_rows: int | None = None,
    expected_revision: int | None = None,
) -> int:
    """Create a dataset or replace it whole; gives the number of rows."""
    upload = start_upload(df, path, keys, buckets, expected_rows, expected_revision)
    commit_upload(df.sparkSession, upload)
    return upload.rows


def publish_update(df: DataFrame, path: str) -> list[tuple[str, str, str | None, str | None]]:
    """Replace the rows of an existing dataset, its schema too when it differs.

    Gives the schema changes, and warns when there are any.
    """
    spark = df.sparkSession
    state = read_state(spark, path)
    if state is None:
        raise FileNotFoundError(f"nothing published at {path}")
    changes = schema_changes(columns_of(_read_parts(spark, path, state, [])), columns_of(df))
    if changes:
        warnings.warn(f"Schema changed: {changes}", stacklevel=2)
    missing = sorted(set(state.keys) - set(df.columns))
    if missing:
        raise ValueError(f"{path} is keyed by {state.keys}; the new rows lack {missing}")
    publish_replace(df, path, state.keys, state.buckets or DEFAULT_BUCKETS, expected_revision=state.revision)
    return changes


def publish_upsert(
    batch: DataFrame,
    path: str,
    keys: Sequence[str],
    order: Sequence[str],
    buckets: int = DEFAULT_BUCKETS,
    newest_wins: bool = False,
    batch_id: tuple[str, int] | None = None,
    as_delta: bool = False,
) -> bool:
    """Merge the last row per key (by ``order``) of a batch into a dataset.

    Rows of the batch replace stored rows of the same key; with ``newest_wins``
    only when they come later in ``order``, which must then be stored. Only buckets that the batch touches
    are read and written; ``as_delta`` writes the batch alone, whatever it touches, and leaves
    merging to readers and to ``compact``. A ``batch_id`` (source, number) already merged is
    skipped, so a replay changes nothing; gives whether anything was merged.

    The batch is cast to the stored types, and a value that does not fit fails
    the run. A column that is neither stored nor in ``order`` is an error; stored
    columns must be there.
    """
    spark = batch.sparkSession
    keys, order = check_keys(keys), list(order)
    state = read_state(spark, path)
    if state is None:
        state = State(schema=batch.schema.json(), keys=keys, buckets=buckets)
    if state.keys != keys:
        raise ValueError(f"{path} is keyed by {state.keys}, not by {keys}")
    if batch_id and state.batches.get(batch_id[0], -1) >= batch_id[1]:
        return False
    delta_order = order if newest_wins else None
    if state.deltas and (not as_delta or state.delta_order != delta_order):
        # Deltas of another kind, and parts that are rewritten, need the rows merged first.
        state = compact(spark, path) or state

    schema = T.StructType.fromJson(json.loads(state.schema))
    columns = [f.name for f in schema.fields]
    unknown = [c for c in batch.columns if c not in columns and c not in order]
    if unknown:
        raise ValueError(f"{path} has no columns {unknown}; publish_update changes its schema")
    if newest_wins and not set(order) <= set(columns):
        raise ValueError(f"{path} does not hold the order {order}")
    stored_types = [_fitting(c, f.dataType).alias(f.name) for c, f in zip(exactly(columns), schema.fields)]
    latest = latest_per_key(batch, keys, order).select(*stored_types)

    version = uuid.uuid4().hex
    following = replace(
        state, batches=state.batches | ({batch_id[0]: batch_id[1]} if batch_id else {}),
        revision=_next_revision(spark, path), previous=state.revision,
    )
    if as_delta:
        folder = _part_folder(path, version, "")
        try:
            written = latest.withColumn(WRITTEN, F.lit(following.revision).cast("bigint"))
            written.hint("rebalance").write.parquet(folder)
        except BaseException:
            storage.remove(spark, folder)
            raise
        following = replace(following, deltas=[*state.deltas, version], delta_order=delta_order)
        commit_upload(spark, Upload(path, version, following, 0))
        return True

    # The batch is read several times below, so it is written down once.
    staged = f"{path.rstrip('/')}/staged/{version}"
    try:
        latest.write.parquet(staged)
        latest = spark.read.schema(schema).parquet(staged)
        touched = [str(r[0]) for r in latest.select(_bucket(keys, state.buckets, state.first_buckets)).distinct().collect()]
        stored = _read_parts(spark, path, state, touched)
        if newest_wins:
            merged = latest_per_key(stored.unionByName(latest), keys, order)
        else:
            merged = upsert_rows(stored, latest, keys)
        upload = _write(merged, path, version, following)
        commit_upload(spark, upload)
    finally:
        storage.remove(spark, staged)
    return True


def compact(spark: SparkSession, path: str, bucket_bytes: int | None = None) -> State | None:
    """Merge the deltas into the buckets they touch, and split buckets where the mean exceeds
    ``bucket_bytes``; None if there is nothing to do.

    Readers see the same rows before and after. Buckets split in turn, whatever their own size: keys are dealt
    by hash, so all grow alike. At most twice as many buckets are made at once.
    """
    state = read_state(spark, path)
    if state is None or not state.keys:
        return None
    root = path.rstrip("/")
    first = state.first_buckets or state.buckets
    stored = sum(storage.size(spark, _part_folder(root, v, b)) for b, v in state.parts.items())
    stored += sum(storage.size(spark, _part_folder(root, v, "")) for v in state.deltas)
    wanted = min(-(-stored // (bucket_bytes or BUCKET_BYTES)), 2 * state.buckets)
    after = max(state.buckets, wanted)
    touched = {str(b) for b in _parents(state.buckets, after, first)}
    if state.deltas:
        rows = spark.read.schema(T.StructType.fromJson(json.loads(state.schema))).parquet(
            *[_part_folder(path, v, "") for v in state.deltas]
        )
        touched |= {str(r[0]) for r in rows.select(_bucket(state.keys, state.buckets, first)).distinct().collect()}
    if not touched:
        return None
    merged = _merged(_read_parts(spark, path, state, sorted(touched)), _read_deltas(spark, path, state), state)
    following = replace(
        state, buckets=after, first_buckets=first, deltas=[], delta_order=None, revision=_next_revision(spark, path),
        previous=state.revision, parts={b: v for b, v in state.parts.items() if b not in touched},
    )
    return commit_upload(spark, _write(merged, path, uuid.uuid4().hex, following))


def compact_if_due(
    spark: SparkSession, path: str, most_deltas: int = MOST_DELTAS, share: float = DELTA_SHARE
) -> State | None:
    """Compact a dataset with many deltas, or with deltas that hold a large share of its bytes, so that
    each stored byte is rewritten once for ``share`` as many new ones."""
    state = read_state(spark, path)
    if state is None or not state.deltas:
        return None
    late = sum(storage.size(spark, _part_folder(path, v, "")) for v in state.deltas)
    stored = sum(storage.size(spark, _part_folder(path, v, b)) for b, v in state.parts.items())
    due = late > share * stored if stored else len(state.deltas) > 1
    return compact(spark, path) if due or len(state.deltas) > most_deltas else None


def _fitting(value: Column, kind: T.DataType) -> Column:
    """``value`` as a stored type; a value that the type cannot hold is an error."""
    cast = value.try_cast(kind)
    problem = F.raise_error(F.concat(F.lit(f"does not fit {kind.simpleString()}: "), value.cast("string")))
    return F.when(value.isNotNull() & cast.isNull(), problem.cast(kind)).otherwise(cast)


def purge_versions(spark: SparkSession, path: str, abandoned: bool = False) -> int:
    """Delete versions that only former states hold, once no reader needs them.

    A version that no state names may be an upload still open; only with
    ``abandoned`` do such go too.
    """
    state = read_state(spark, path)
    root = f"{path.rstrip('/')}/versions"
    former = [r for r in _revisions(spark, path) if state and r < state.revision]
    states = [s for s in (state, *(_state_of(spark, path, r) for r in former)) if s]
    known = {version for s in states for version in s.versions}
    removed = 0
    for version in storage.children(spark, root):
        if version not in known and not abandoned:
            continue
        live = {b for b, v in state.parts.items() if v == version} if state else set()
        if state and version in state.deltas:
            continue
        if not live:
            storage.remove(spark, f"{root}/{version}")
            removed += 1
            continue
        for name in storage.children(spark, f"{root}/{version}"):
            if name.startswith(BUCKET + "=") and name.split("=", 1)[1] not in live:
                storage.remove(spark, f"{root}/{version}/{name}")
    for revision in former:
        storage.remove(spark, _state_file(path, revision))
    claims = f"{path.rstrip('/')}/claims"
    for claim in storage.children(spark, claims):
        if state and int(claim.split("-")[0]) <= state.revision:
            storage.remove(spark, f"{claims}/{claim}")
    return removed
