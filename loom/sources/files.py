"""Sequence files and genome documents as data sources: spark.read.format("fasta"), spark.read.format("genomes"), and their writers.

Reading is cut into byte ranges (fasta) or groups of files (genomes) of about `splitBytes`; batches are Arrow. Paths are those that
pyarrow's file systems open on every node: local or mounted folders, hdfs://, s3:// and the like.
"""

from __future__ import annotations

import gzip
import sys
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from posixpath import basename, dirname

import pyarrow as pa
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, EqualNullSafe, EqualTo, Filter, In, InputPartition, IsNotNull, StringStartsWith, WriterCommitMessage,
)

#: Bytes of a partition, unless the option splitBytes says otherwise; of a read; of a batch's texts.
SPLIT, _BLOCK, _BATCH = 64 << 20, 1 << 20, 4 << 20

FASTA = "label string, comment string, sequence string, file string, at long"
DOCUMENTS = "name string, document string, file string"


def register(spark: SparkSession) -> None:
    """Makes the formats known to the session, and lets it push filters into them."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    for source in (FastaSource, GenomeSource):
        spark.dataSource.register(source)


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path, and the path in it; without a scheme it is local."""
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def listed(path: str) -> list[fs.FileInfo]:
    """The file at path, or all below it by name; hidden ones (of names that begin with . or _) don't count."""
    system, own = opened(path)
    info = system.get_file_info(own)
    if info.type == fs.FileType.NotFound:
        raise FileNotFoundError(path)
    if info.type == fs.FileType.File:
        return [info]
    found = system.get_file_info(fs.FileSelector(own, recursive=True))
    inside = lambda f: not any(p[:1] in "._" for p in f.path[len(own.rstrip("/")) + 1 :].split("/"))
    return sorted((f for f in found if f.type == fs.FileType.File and inside(f)), key=lambda f: f.path)


@dataclass
class Stretch(InputPartition):
    """Byte ranges (file, from, to) that one task reads."""

    ranges: list[tuple[str, int, int]] = field(default_factory=list)


def stretches(files: Iterable[tuple[str, int, bool]], split: int) -> list[Stretch]:
    """Ranges of about split bytes: large files are cut where that is allowed, small ones put together."""
    out, now, size = [], Stretch(), 0
    for path, length, cut in files:
        for a in range(0, max(length, 1), split if cut else max(length, 1)):
            b = min(length, a + split) if cut else length
            if now.ranges and size + b - a > split:
                out.append(now)
                now, size = Stretch(), 0
            now.ranges.append((path, a, b))
            size += b - a
    return [*out, now] if now.ranges else out


class Wanted:
    """Filters that a reader checks itself, by column: what may stand there, and how it has to begin."""

    def __init__(self, columns: tuple[str, ...], texts: tuple[str, ...]) -> None:
        self.columns, self.texts = columns, texts
        self.values: dict[str, set] = {}
        self.begins: list[tuple[str, str]] = []

    def take(self, filters: list[Filter]) -> Iterator[Filter]:
        """Keeps the filters that it can check; gives back the others."""
        for f in filters:
            place = getattr(f, "attribute", ())  # a negation has none
            name = place[0] if len(place) == 1 else ""
            if isinstance(f, IsNotNull) and name in (*self.columns, *self.texts):
                continue  # no column here is ever null
            if name in self.columns and isinstance(f, EqualTo | EqualNullSafe | In):
                values = set(f.value if isinstance(f, In) else [f.value])
                self.values[name] = self.values.get(name, values) & values
            elif name in self.columns and isinstance(f, StringStartsWith):
                self.begins.append((name, f.value))
            else:
                yield f

    def fits(self, **values: str) -> bool:
        return all(values[c] in v for c, v in self.values.items() if c in values) and all(values[c].startswith(v) for c, v in self.begins if c in values)


def batches(rows: Iterator[tuple[tuple, int]], schema: T.StructType) -> Iterator[pa.RecordBatch]:
    """Arrow batches of (values, bytes), of about _BATCH bytes."""
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow, held, size = to_arrow_schema(schema), [], 0
    for values, n in rows:
        held.append(values)
        size += n + 64
        if size >= _BATCH:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), arrow, strict=True)], schema=arrow)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), arrow, strict=True)], schema=arrow)


# --- fasta -------------------------------------------------------------------------------------------------------------


def records(blocks: Iterator[bytes], first: int, start: int, end: int) -> Iterator[tuple[int, bytes]]:
    """(place, record) of the records that begin at start or later and before end.

    blocks: the bytes from place `first` on, which is start - 1 at most (0 for the file's beginning). A record begins with > at the
    beginning of a line; what stands before the first is no record. One record is held at a time.
    """
    data, done = b"\n" + next(blocks, b"") if start == 0 else next(blocks, b""), False
    base = first - (start == 0)  # the place of data[0]
    begin = -1  # the place in data of the record that is open
    look = 0
    while True:
        at = data.find(b"\n>", look)
        if at < 0:
            more = b"" if done else next(blocks, b"")
            done = not more
            if done:
                break
            drop = begin if begin >= 0 else max(0, len(data) - 1)
            look, data, base, begin = max(0, len(data) - drop - 1), data[drop:] + more, base + drop, 0 if begin >= 0 else -1
            continue
        if begin >= 0:
            yield base + begin, data[begin : at + 1]
        begin, look = at + 1, at + 1
        if base + begin >= end:
            return
        if begin > _BLOCK:
            data, base, begin, look = data[begin:], base + begin, 0, 0
    if begin >= 0:
        yield base + begin, data[begin:]


class FastaReader(DataSourceReader):
    def __init__(self, path: str, schema: T.StructType, split: int) -> None:
        self.path, self.schema, self.split = path, schema, split
        self.wanted = Wanted(("label", "file"), ("comment", "sequence", "at"))

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:  # noqa: N802
        return list(self.wanted.take(filters))

    def partitions(self) -> list[Stretch]:
        files = [f for f in listed(self.path) if self.wanted.fits(file=f.path)]
        return stretches(((f.path, f.size, not f.path.endswith(".gz")) for f in files), self.split) or [Stretch()]

    def read(self, partition: Stretch) -> Iterator[pa.RecordBatch]:
        names = self.schema.names

        def rows() -> Iterator[tuple[tuple, int]]:
            system, _ = opened(self.path)
            for path, start, end in partition.ranges:
                for at, record in records(_blocks(system, path, max(0, start - 1)), max(0, start - 1), start, sys.maxsize if path.endswith(".gz") else end):
                    head, _, body = record.partition(b"\n")
                    label, _, comment = head[1:].decode("utf-8", "replace").strip().partition(" ")
                    label, _, rest = label.partition("\t")
                    if not self.wanted.fits(label=label):
                        continue
                    values = {"label": label, "comment": f"{rest} {comment}".strip() if rest else comment.strip(), "file": path, "at": at}
                    if "sequence" in names:
                        values["sequence"] = b"".join(body.split()).decode("utf-8", "replace")
                    yield tuple(values[n] for n in names), len(record)

        return batches(rows(), self.schema)


def _blocks(system: fs.FileSystem, path: str, start: int) -> Iterator[bytes]:
    packed = path.endswith(".gz")
    with system.open_input_file(path) as file:
        file.seek(0 if packed else start)
        source = gzip.GzipFile(fileobj=file) if packed else file
        while block := source.read(_BLOCK):
            yield block


@dataclass
class Written(WriterCommitMessage):
    """Files that a task has staged."""

    files: list[str]


class StagedWriter(DataSourceArrowWriter):
    """Writes files to a staging folder; commit moves those of tasks that succeeded to their place, so a retried task adds nothing twice."""

    def __init__(self, path: str, overwrite: bool) -> None:
        self.path, self.overwrite, self.stage = path.rstrip("/"), overwrite, f"_staged-{uuid.uuid4().hex}"
        system, folder = self.staged()
        system.create_dir(folder, recursive=True)  # here only: a task that outlives an aborted job can't bring it back

    def staged(self) -> tuple[fs.FileSystem, str]:
        system, own = opened(self.path)
        return system, f"{own}/{self.stage}"

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        system, own = opened(self.path)
        if self.overwrite:
            for f in system.get_file_info(fs.FileSelector(own, recursive=False, allow_not_found=True)):
                if basename(f.path) != self.stage:
                    (system.delete_file if f.type == fs.FileType.File else system.delete_dir)(f.path)
        for m in messages:
            for file in m.files if m else []:
                system.move(file, f"{own}/{basename(file)}")
        self._clear()

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        self._clear()

    def _clear(self) -> None:
        system, own = opened(self.path)
        if system.get_file_info(f"{own}/{self.stage}").type == fs.FileType.Directory:
            system.delete_dir(f"{own}/{self.stage}")


class FastaWriter(StagedWriter):
    def __init__(self, path: str, overwrite: bool, names: list[str], width: int, packed: bool) -> None:
        super().__init__(path, overwrite)
        self.names, self.width, self.packed = names, width, packed

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        system, folder = self.staged()
        file, some = f"{folder}/part-{uuid.uuid4().hex}.fasta{'.gz' if self.packed else ''}", False
        with system.open_output_stream(file, compression="gzip" if self.packed else None) as out:
            for batch in iterator:
                columns = {n: batch.column(i).to_pylist() for i, n in enumerate(self.names)}
                for i in range(batch.num_rows):
                    out.write(self.record(*[columns[n][i] if n in columns else "" for n in ("label", "comment", "sequence")]))
                    some = True
        if not some:
            system.delete_file(file)
        return Written([file] if some else [])

    def record(self, label: str | None, comment: str | None, sequence: str | None) -> bytes:
        comment, sequence = " ".join((comment or "").split()), "".join((sequence or "").split())
        if not label or label.split() != [label] or sequence.startswith(">"):
            raise ValueError(f"no record of a sequence file: label {label!r}")
        if self.width and ">" not in sequence:
            sequence = "\n".join(sequence[i : i + self.width] for i in range(0, len(sequence), self.width))
        return f">{label}{' ' if comment else ''}{comment}\n{sequence}\n".encode()


class FastaSource(DataSource):
    """(label, comment, sequence, file, at): a row for each record, at its byte in the file (of a .gz: unpacked).

    Options: path, splitBytes; for writing also width (letters a line, 0: all on one) and compression (gzip). Give a schema with fewer
    columns to read fewer: without `sequence` no sequence is built. Equality, IN and prefixes of label and file are checked while
    reading; files that don't fit aren't opened. A label without a sequence has an empty one; text before the first > is no record;
    blanks in sequences don't count. Writing wants a label without blanks; null comments and sequences are empty.
    """

    @classmethod
    def name(cls) -> str:
        return "fasta"

    def schema(self) -> str:
        return FASTA

    def reader(self, schema: T.StructType) -> FastaReader:
        return FastaReader(self.options["path"], schema, int(self.options.get("splitBytes", SPLIT)))

    def writer(self, schema: T.StructType, overwrite: bool) -> FastaWriter:
        return FastaWriter(self.options["path"], overwrite, schema.names, int(self.options.get("width", 0)), self.options.get("compression") == "gzip")


# --- genome documents --------------------------------------------------------------------------------------------------


class GenomeReader(DataSourceReader):
    def __init__(self, path: str, schema: T.StructType, split: int) -> None:
        self.path, self.schema, self.split = path, schema, split
        self.wanted = Wanted(("name", "file"), ("document",))

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:  # noqa: N802
        return list(self.wanted.take(filters))

    def partitions(self) -> list[Stretch]:
        files: dict[str, fs.FileInfo] = {}
        for f in listed(self.path):
            if (name := genome_name(f.path)) is not None and (name not in files or (dirname(f.path), f.path) < (dirname(files[name].path), files[name].path)):
                files[name] = f
        fit = [f for name, f in files.items() if self.wanted.fits(name=name, file=f.path)]
        return stretches(((f.path, f.size, False) for f in fit), self.split) or [Stretch()]

    def read(self, partition: Stretch) -> Iterator[pa.RecordBatch]:
        names = self.schema.names

        def rows() -> Iterator[tuple[tuple, int]]:
            system, _ = opened(self.path)
            for path, _, _ in partition.ranges:
                text = b"".join(_blocks(system, path, 0)).decode() if "document" in names else ""
                values = {"name": genome_name(path), "document": text, "file": path}
                yield tuple(values[n] for n in names), len(text)

        return batches(rows(), self.schema)


def genome_name(path: str) -> str | None:
    """The genome's id in a document's file name, <id>.gto or <id>.gto.gz."""
    name = basename(path).removesuffix(".gz")
    return name.removesuffix(".gto") if name.endswith(".gto") else None


class GenomeWriter(StagedWriter):
    def __init__(self, path: str, overwrite: bool, names: list[str], packed: bool) -> None:
        super().__init__(path, overwrite)
        self.names, self.packed = names, packed

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        system, folder = self.staged()
        folder, files = f"{folder}/{uuid.uuid4().hex}", []
        system.create_dir(folder, recursive=False)
        for batch in iterator:
            for name, document in zip(*[batch.column(self.names.index(n)).to_pylist() for n in ("name", "document")], strict=True):
                if not name or "/" in name or name[0] in "._":
                    raise ValueError(f"no name for a genome's file: {name!r}")
                files.append(f"{folder}/{name}.gto{'.gz' if self.packed else ''}")
                with system.open_output_stream(files[-1], compression="gzip" if self.packed else None) as out:
                    out.write((document or "{}").encode())
        return Written(files)


class GenomeSource(DataSource):
    """(name, document, file): a row for each genome document <name>.gto or <name>.gto.gz below path, and a file for each row written.

    Of documents of one name the first by folder counts. Equality, IN and prefixes of name and file decide which files are opened
    at all, so a lookup of some genomes opens their files only. Written files of the same name are replaced. A null document is {}.
    """

    @classmethod
    def name(cls) -> str:
        return "genomes"

    def schema(self) -> str:
        return DOCUMENTS

    def reader(self, schema: T.StructType) -> GenomeReader:
        return GenomeReader(self.options["path"], schema, int(self.options.get("splitBytes", SPLIT)))

    def writer(self, schema: T.StructType, overwrite: bool) -> GenomeWriter:
        return GenomeWriter(self.options["path"], overwrite, schema.names, self.options.get("compression") == "gzip")


def genomes(spark: SparkSession, path: str, schema: str, ids: list[str] | None = None) -> DataFrame:
    """The genomes in the folder, or those of the given ids, whose files alone are opened; documents are parsed in the JVM."""
    register(spark)
    found = spark.read.format("genomes").option("path", path).load()
    found = found if ids is None else found.where(F.col("name").isin(ids))
    return found.select("name", F.from_json("document", schema).alias("g")).select("name", "g.*")


cloudpickle.register_pickle_by_value(sys.modules[__name__])
