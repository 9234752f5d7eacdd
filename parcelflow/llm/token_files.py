"""Token ids in Arrow stream files of equal-length sequences.

A file ``part-*.arrows`` is an Arrow stream whose rows are ``(tokens: fixed_size_list<uint16 or uint32>[seq_len],
mask: fixed_size_list<bool>[seq_len])``: the ids of a range of documents in ascending doc_id order,
laid end to end and cut into sequences. Every batch holds ``batch_rows`` sequences (the last of a file
fewer; its last sequence is padded, mask false). Equal batches have equal sizes, so ``batch k`` starts at
``first + k * stride`` and a memory map gives any sequence without copying. ``part-*.index`` is an
Arrow stream of (doc_id, start, n_tokens), start counted within the file. The manifest, a Parquet table, names the
files that count, with their first global position: attempts that were lost or ran twice are not in it.

Files are written by tasks through ``pyarrow.fs``, to the shared folder only. Null text is empty and holds the
end id alone; repeated rows are written as often as they occur, equal doc_ids ordered by text; a null
doc_id comes first; an empty table gives an empty manifest.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from parcelflow.llm import bpe
from parcelflow.llm.common import shuffle_width, stored, whole_text

INDEX = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])
MANIFEST = "part int, file string, n_docs long, n_tokens long, seq_len int, batch_rows int, first long, stride long"


def _open(uri: str):
    """(file system, path) of a shared folder's URI or plain path."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)


class _SequenceFile:
    """Collects ids and writes a batch whenever one is full."""

    def __init__(self, sink, width: pa.DataType, seq_len: int, batch_rows: int):
        self.sink, self.width, self.seq_len, self.full = sink, width, seq_len, seq_len * batch_rows
        self.schema = pa.schema([("tokens", pa.list_(width, seq_len)), ("mask", pa.list_(pa.bool_(), seq_len))])
        self.writer = pa.ipc.new_stream(sink, self.schema)
        self.first = self.stride = 0
        self.held: list[np.ndarray] = []
        self.n_held = 0

    def add(self, ids: np.ndarray) -> None:
        self.held.append(ids)
        self.n_held += len(ids)
        if self.n_held >= self.full:
            flat = np.concatenate(self.held)
            cut = len(flat) - len(flat) % self.full
            for at in range(0, cut, self.full):
                self._write(flat[at : at + self.full])
            self.held, self.n_held = [flat[cut:]], len(flat) - cut

    def _write(self, ids: np.ndarray) -> None:
        used = len(ids)
        padded = np.zeros(-(-used // self.seq_len) * self.seq_len, self.width.to_pandas_dtype())
        padded[:used] = ids
        mask = np.arange(len(padded)) < used
        columns = [pa.FixedSizeListArray.from_arrays(pa.array(x), self.seq_len) for x in (padded, mask)]
        batch = pa.RecordBatch.from_arrays(columns, schema=self.schema)
        self.writer.write_batch(batch)
        if not self.first:  # the schema went out with the first batch
            self.stride = pa.ipc.get_record_batch_size(batch)
            self.first = self.sink.tell() - self.stride

    def close(self) -> None:
        if self.n_held:
            self._write(np.concatenate(self.held))
        self.writer.close()
        self.sink.close()


def write_token_files(
    docs: DataFrame, folder: str, tokenizer: str, end_id: int = 1, seq_len: int = 1024, batch_rows: int = 64
) -> DataFrame:
    """Write all documents below ``folder``; returns the manifest with ``first_position`` per file."""
    width = pa.uint16() if bpe.vocabulary_size(tokenizer) <= 1 << 16 else pa.uint32()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, out = TaskContext.get().partitionId(), None
        name = f"part-{part:06d}-{uuid.uuid4().hex[:12]}"
        n_docs = position = 0
        for batch in batches:
            if out is None:
                fs, path = _open(folder)
                fs.create_dir(path, recursive=True)
                out = _SequenceFile(fs.open_output_stream(f"{path}/{name}.arrows"), width, seq_len, batch_rows)
                index = fs.open_output_stream(f"{path}/{name}.index")
                index_writer = pa.ipc.new_stream(index, INDEX)
            for at in range(0, len(batch), 1000):
                rows = batch.slice(at, 1000)
                starts, sizes = [], []
                for ids in bpe.ids_of(tokenizer, rows["text"]):
                    whole = np.append(ids, np.uint32(end_id))
                    out.add(whole)
                    starts.append(position)
                    sizes.append(len(whole))
                    position += len(whole)
                n_docs += len(rows)
                columns = [rows["doc_id"], pa.array(starts, pa.int64()), pa.array(sizes, pa.int64())]
                index_writer.write_batch(pa.RecordBatch.from_arrays(columns, schema=INDEX))
        if out is not None:
            out.close()
            index_writer.close()
            index.close()
            row = [part, name, n_docs, position, seq_len, batch_rows, out.first, out.stride]
            names = [f.split()[0] for f in MANIFEST.split(", ")]
            types = [pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([v], t) for v, t in zip(row, types, strict=True)], names=names
            )

    spark = docs.sparkSession
    ordered = (
        docs.select("doc_id", whole_text().alias("text"))
        .repartitionByRange(shuffle_width(spark), "doc_id")
        .sortWithinPartitions("doc_id", "text")
    )
    # one row per file; the window below runs over the files, not the documents
    written = stored(ordered.mapInArrow(write, MANIFEST), "token-manifest")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return written.withColumn("first_position", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


def sequence(folder: str, name: str, row: int, first: int, stride: int, batch_rows: int):
    """(tokens, mask) of one sequence of a local file, read through a memory map at its known place."""
    _, path = _open(folder)
    source = pa.memory_map(f"{path}/{name}.arrows")
    schema = pa.ipc.open_stream(source).schema
    source.seek(first + row // batch_rows * stride)
    batch = pa.ipc.read_record_batch(pa.ipc.read_message(source), schema)
    return batch["tokens"][row % batch_rows].values, batch["mask"][row % batch_rows].values


def read_token_files(spark: SparkSession, folder: str, manifest: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of all files; ids are little-endian uint32.

    A task reads its files a batch at a time and holds one batch and one document.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = _open(folder)
        for batch in batches:
            for row in batch.to_pylist():
                with (
                    fs.open_input_file(f"{path}/{row['file']}.arrows") as tokens,
                    fs.open_input_file(f"{path}/{row['file']}.index") as index,
                ):
                    ids = _ids(pa.ipc.open_stream(tokens))
                    held, at = np.zeros(0, np.uint32), 0
                    for docs in pa.ipc.open_stream(index):
                        out = []
                        for n in docs["n_tokens"].to_pylist():
                            if len(held) - at < n:
                                parts, have = [held[at:]], len(held) - at
                                while have < n:
                                    parts.append(next(ids))
                                    have += len(parts[-1])
                                held, at = np.concatenate(parts), 0
                            out.append(held[at : at + n].tobytes())
                            at += n
                        starts = pa.array(docs["start"].to_numpy() + row["first_position"], pa.int64())
                        columns = [docs["doc_id"], starts, docs["n_tokens"], pa.array(out, pa.binary())]
                        yield pa.RecordBatch.from_arrays(columns, schema=schema)

    files = manifest.select("file", "first_position").repartition(shuffle_width(spark))
    return files.mapInArrow(read, "doc_id long, start long, n_tokens long, ids binary")


def _ids(stream: pa.ipc.RecordBatchStreamReader) -> Iterator[np.ndarray]:
    """The unpadded ids of each batch as little-endian uint32."""
    for batch in stream:
        mask = batch["mask"].flatten().to_numpy(zero_copy_only=False)
        yield batch["tokens"].flatten().to_numpy()[mask].astype("<u4")


