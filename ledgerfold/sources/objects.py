"""Content-addressed gzip objects: parts of observations, shards of state, and their proofs.

Parts are cut greedily at a size limit.  That is a walk over the lines in order, but only over their
sizes: the walk assigns numbers, then every part is compressed and written by a task of its own.
Shards are streamed: a sorted prefix goes through the compressor as it arrives.  Objects are written
under a temporary name and renamed; an existing object with other bytes is an error.
"""

from __future__ import annotations

import gzip
import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerfold.functions import canon
from ledgerfold.schemas import DATA_PART, SHARD

#: Uncompressed bytes of a part; a longer single line is a part of its own.
MAX_PART = 50 * 1024 * 1024


def filesystem(root: str) -> tuple[pafs.FileSystem, str]:
    """File system and base path of a URI or a local path."""
    if "://" not in root:
        root = "file://" + root
    system, path = pafs.FileSystem.from_uri(root)
    return system, path.rstrip("/")


class ObjectWriter:
    """Streams lines into one gzip object; its name is the hash of its bytes, known at the end."""

    def __init__(self, root: str, prefix: str):
        self.fs, self.base = filesystem(root)
        self.prefix = prefix
        self.temp = f"{self.base}/{prefix}/.writing-{uuid.uuid4().hex}"
        self.fs.create_dir(f"{self.base}/{prefix}", recursive=True)
        self.out = self.fs.open_output_stream(self.temp, compression=None)
        self.packed, self.plain = hashlib.sha256(), hashlib.sha256()
        self.packed_size = self.plain_size = self.count = 0
        self.gz = gzip.GzipFile(filename="", mode="wb", compresslevel=9, fileobj=self, mtime=0)

    def write(self, data: bytes) -> int:  # what the compressor gives
        self.packed.update(data)
        self.packed_size += len(data)
        self.out.write(data)
        return len(data)

    def flush(self) -> None:
        pass

    def line(self, data: bytes) -> None:
        self.plain.update(data)
        self.plain_size += len(data)
        self.count += 1
        self.gz.write(data)

    def close(self) -> tuple[str, int, str, int, str, int]:
        """Path, compressed size and hash, uncompressed size and hash, lines."""
        self.gz.close()
        self.out.close()
        digest = self.packed.hexdigest()
        path = f"{self.prefix}/sha256/{digest[:2]}/{digest}.jsonl.gz"
        target = f"{self.base}/{path}"
        if self.fs.get_file_info(target).type != pafs.FileType.NotFound:
            with self.fs.open_input_stream(target, compression=None) as f:
                if hashlib.sha256(f.read()).hexdigest() != digest:
                    raise OSError(f"immutable object differs: {path}")
            self.fs.delete_file(self.temp)
        else:
            self.fs.create_dir(target.rpartition("/")[0], recursive=True)
            self.fs.move(self.temp, target)
        return path, self.packed_size, "sha256:" + digest, self.plain_size, "sha256:" + self.plain.hexdigest(), self.count


def greedy_parts(lines: DataFrame, group: str, order: list[str], limit: int = MAX_PART) -> DataFrame:
    """``lines`` with ``ordinal``: the number of its part in its group, in the given order.

    ``lines`` has a column ``line``.  A part is closed when the next line would take it beyond the limit.
    """
    keys = [group, *order]
    kinds = {f.name: f.dataType.simpleString() for f in lines.schema.fields}
    sizes = lines.select(*keys, F.octet_length("line").cast("bigint").alias("size")).repartition(group).sortWithinPartitions(*keys)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, ordinal, total = None, 0, 0
        for b in batches:
            out = []
            for g, n in zip(b[group].to_pylist(), b["size"].to_pylist(), strict=True):
                if g != now:
                    now, ordinal, total = g, 0, 0
                if total and total + n > limit:
                    ordinal, total = ordinal + 1, 0
                total += n
                out.append(ordinal)
            yield pa.RecordBatch.from_arrays([*(b[k] for k in keys), pa.array(out, pa.int32())], [*keys, "ordinal"])

    schema = ", ".join(f"`{k}` {kinds[k]}" for k in keys) + ", ordinal int"
    return lines.join(sizes.mapInArrow(walk, schema), keys)


def _stream_objects(root: str, prefix: str, group: list[str], line: str = "line"):
    """Rows sorted by ``group`` in, one row of proofs for each value of it out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [*group, "path", "compressed_size", "compressed_sha256", "uncompressed_size", "uncompressed_sha256", "record_count"]
        now, writer = None, None
        kinds: list[pa.DataType] = []

        def done() -> pa.RecordBatch:
            proofs = writer.close()
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(now, kinds, strict=True)] + [pa.array([p]) for p in proofs], names)

        for b in batches:
            kinds = [b[g].type for g in group]
            for *g, text in zip(*(b[c].to_pylist() for c in group), b[line].to_pylist(), strict=True):
                if g != now:
                    if writer:
                        yield done()
                    now, writer = g, ObjectWriter(root, prefix)
                writer.line(text.encode())
        if writer:
            yield done()

    return run


def write_parts(lines: DataFrame, root: str, group: str, order: list[str], limit: int = MAX_PART, prefix: str = "objects") -> DataFrame:
    """``group`` and the descriptor of each part, from ``lines`` with ``line`` (canonical, with line feed)."""
    kind = lines.schema[group].dataType.simpleString()
    cut = greedy_parts(lines, group, order, limit)
    ready = cut.repartition(group, "ordinal").sortWithinPartitions(group, "ordinal", *order)
    fields = DATA_PART.replace("ordinal int, ", "")
    return ready.select(group, "ordinal", "line").mapInArrow(_stream_objects(root, prefix, [group, "ordinal"]), f"`{group}` {kind}, ordinal int, {fields}")


def write_shards(records: DataFrame, root: str, key: str, prefix: str) -> DataFrame:
    """Descriptors of the shards of state records, by two hex characters of their key; ``records`` has ``line``."""
    tasks = min(256, int(records.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    keyed = records.select(F.substring(key, 8, 2).alias("prefix"), F.col(key).alias("k"), "line").repartition(tasks, "prefix").sortWithinPartitions("prefix", "k")
    return keyed.select("prefix", "line").mapInArrow(_stream_objects(root, prefix, ["prefix"]), SHARD)


def shard_violations(records: DataFrame, key: str) -> DataFrame:
    """``rule, key`` for malformed and repeated keys."""
    bad = records.filter(~F.coalesce(canon.is_hash(F.col(key)), F.lit(False))).select(F.lit("key_malformed").alias("rule"), F.col(key).alias("key"))
    return bad.unionByName(records.groupBy(key).count().filter("count > 1").select(F.lit("key_repeats").alias("rule"), F.col(key).alias("key")))


def read_objects(descriptors: DataFrame, root: str, group: list[str]) -> DataFrame:
    """``group, line_no, line, fault``: the lines of every object, or one row with the proof that failed.

    An object is read by one task in a stream; nothing of it is kept but the line at hand.
    """
    kinds = {f.name: f.dataType.simpleString() for f in descriptors.schema.fields}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = filesystem(root)
        for b in batches:
            for i in range(b.num_rows):
                row = {c: b[c][i].as_py() for c in b.schema.names}

                def out(texts: list[str | None], first: int, fault: str | None, i: int = i, b: pa.RecordBatch = b) -> pa.RecordBatch:
                    n = len(texts)
                    return pa.RecordBatch.from_arrays([*(pa.repeat(b[g][i], n) for g in group), pa.array(range(first, first + n), pa.int64()), pa.array(texts, pa.string()), pa.array([fault] * n, pa.string())], [*group, "line_no", "line", "fault"])

                fault, n, size, plain = None, 0, 0, hashlib.sha256()
                held: list[str | None] = []
                try:
                    with system.open_input_stream(f"{base}/{row['path']}", compression=None) as f:
                        data = f.read()  # compressed and of bounded size
                    if "sha256:" + hashlib.sha256(data).hexdigest() != row["compressed_sha256"]:
                        fault = "compressed_hash_differs"
                    elif len(data) != row["compressed_size"]:
                        fault = "compressed_size_differs"
                    else:
                        last = b"\n"
                        for last in gzip.GzipFile(fileobj=pa.BufferReader(data)):
                            plain.update(last)
                            size += len(last)
                            held.append(last.decode().removesuffix("\n"))
                            n += 1
                            if len(held) == 1000:
                                yield out(held, n - len(held), None)
                                held = []
                        if not last.endswith(b"\n"):
                            fault = "line_feed_missing"
                        elif size != row["uncompressed_size"]:
                            fault = "uncompressed_size_differs"
                        elif "sha256:" + plain.hexdigest() != row["uncompressed_sha256"]:
                            fault = "uncompressed_hash_differs"
                        elif n != row["record_count"]:
                            fault = "record_count_differs"
                except FileNotFoundError:
                    fault = "object_missing"
                except (OSError, EOFError, UnicodeDecodeError):
                    fault = "object_malformed"
                if held:
                    yield out(held, n - len(held), None)
                if fault:
                    yield out([None], n, fault)

    schema = ", ".join(f"`{g}` {kinds[g]}" for g in group) + ", line_no bigint, line string, fault string"
    return descriptors.repartition(max(1, int(descriptors.sparkSession.conf.get("spark.sql.shuffle.partitions"))), "path").mapInArrow(run, schema)


# single documents, on the driver


def write_document(root: str, path: str, document: object) -> str:
    """Canonical JSON under a name; overwrites, returns the hash of the file."""
    system, base = filesystem(root)
    data = canon.file_bytes(document)
    target = f"{base}/{path}"
    system.create_dir(target.rpartition("/")[0], recursive=True)
    temp = f"{target}.writing-{uuid.uuid4().hex}"
    with system.open_output_stream(temp, compression=None) as f:
        f.write(data)
    system.move(temp, target)
    return canon.bytes_hash(data)


def read_document(root: str, path: str, digest: str | None = None) -> dict:
    """A JSON object, which must be canonical and have the given hash."""
    import json

    system, base = filesystem(root)
    with system.open_input_stream(f"{base}/{path}", compression=None) as f:
        data = f.read()
    if digest is not None and canon.bytes_hash(data) != digest:
        raise ValueError(f"{path}: hash differs")
    value = json.loads(data)
    if not isinstance(value, dict) or canon.file_bytes(value) != data:
        raise ValueError(f"{path}: not a canonical object")
    return value


def exists(root: str, path: str) -> bool:
    system, base = filesystem(root)
    return system.get_file_info(f"{base}/{path}").type != pafs.FileType.NotFound


def list_files(spark, root: str) -> DataFrame:
    """``path, sha256, size`` of every file under a folder."""
    system, base = filesystem(root)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root if "://" in root else "file://" + root)
    return files.select(F.expr(f"substring(path, locate('{base}/', path) + {len(base) + 1})").alias("path"), F.concat(F.lit("sha256:"), F.sha2("content", 256)).alias("sha256"), F.col("length").alias("size"))


def _stream_digest(group: list[str], render, before: bytes, between: bytes, after: bytes):
    """Rows sorted by ``group`` in, one hash per group out; nothing but the hash is held."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, h, n, kinds = None, None, 0, []

        def done() -> pa.RecordBatch:
            h.update(after)
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(now, kinds, strict=True)] + [pa.array([n], pa.int64()), pa.array([h.hexdigest()])], [*group, "n", "digest"])

        for b in batches:
            kinds = [b[g].type for g in group]
            rows = b.to_pylist()
            for r in rows:
                g = [r[x] for x in group]
                if g != now:
                    if h:
                        yield done()
                    now, h, n = g, hashlib.sha256(before), 0
                if n:
                    h.update(between)
                h.update(render(r))
                n += 1
        if h:
            yield done()

    return run


def ordered_digests(rows: DataFrame, group: str, text: str) -> DataFrame:
    """``group, n, digest``: hash of the texts of each group in order, joined by line feeds."""
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    kind = rows.schema[group].dataType.simpleString()
    ordered = rows.select(group, F.col(text).alias("t")).repartition(tasks, group).sortWithinPartitions(group, "t")
    return ordered.mapInArrow(_stream_digest([group], lambda r: r["t"].encode(), b"", b"\n", b""), f"`{group}` {kind}, n bigint, digest string")


def tree_digest(files: DataFrame) -> DataFrame:
    """``n_files, digest``: hash of the canonical list of paths and hashes in order of path, as a file.

    The order is one, so one task hashes the sorted stream; it holds no list. No files make no row.
    """
    one = files.select(F.lit(0).alias("g"), canon.canonical_json(F.struct("path", "sha256")).alias("t"), "path").repartition(1).sortWithinPartitions("path")
    out = one.select("g", "t").mapInArrow(_stream_digest(["g"], lambda r: r["t"].encode(), b"[", b",", b"]\n"), "g int, n bigint, digest string")
    return out.select(F.col("n").alias("n_files"), F.concat(F.lit("sha256:"), "digest").alias("digest"))


def tree_diff(current: DataFrame, previous: DataFrame) -> DataFrame:
    """Files that are new or changed, with their sizes."""
    before = previous.select("path", F.col("sha256").alias("before"))
    return current.join(before, "path", "left").filter(~F.col("sha256").eqNullSafe(F.col("before"))).select("path", "sha256", "size")


def copy_tree(source: str, target: str, names: tuple[str, ...] = ("feed.json", "scopes", "objects")) -> int:
    """Copy a published tree: objects first, the root document last. Unexpected top-level names are an error."""
    a, base_a = filesystem(source)
    b, base_b = filesystem(target)
    top = {i.base_name for i in a.get_file_info(pafs.FileSelector(base_a))}
    if extra := top - set(names):
        raise ValueError(f"unexpected names: {sorted(extra)}")
    n = 0
    for name in sorted(top, key=lambda x: (x == "feed.json", x)):
        info = a.get_file_info(f"{base_a}/{name}")
        files = [info] if info.type == pafs.FileType.File else [i for i in a.get_file_info(pafs.FileSelector(info.path, recursive=True)) if i.type == pafs.FileType.File]
        for i in files:
            path = f"{base_b}/{i.path[len(base_a) + 1:]}"
            b.create_dir(path.rpartition("/")[0], recursive=True)
            with a.open_input_stream(i.path, compression=None) as x, b.open_output_stream(path, compression=None) as y:
                while data := x.read(1 << 20):
                    y.write(data)
            n += 1
    return n
