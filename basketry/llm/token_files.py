"""Token-id files: all ids of a shard in one array, document boundaries in Elias-Fano form.

Documents are range-partitioned by id and sorted; each partition becomes a shard of two files:

* ``shard-N.ids``: the ids of its documents one after the other, little-endian, 2 bytes each if the vocabulary has at
  most 65,536 ids, else 4;
* ``shard-N.ef``: a header, then in Elias-Fano form the boundaries (a document more than there are) and the document
  ids, so that any document's ids are found by two selections.

A task writes under a name of its own and then renames, so a repeated or lost task leaves no torn file. The manifest,
a row per shard, is a table that Spark commits; only it goes through the driver, and it gives each shard its start.
Files go to the shared folder through Arrow's file systems (``file:``, ``hdfs:``, ``s3:``).

Defined results: a null text is empty and has the end id alone; documents of a null id come first; rows are kept one by
one, equal ids in the order of their texts; extra columns are left out.
"""

from __future__ import annotations

import os
import struct
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import input_columns, new_folder, of_worker, ship, table, texts_of, utf8, written
from basketry.llm.elias_fano import EliasFano

END_ID = 2
#: most words whose ids a worker remembers
REMEMBERED = 1_000_000
#: documents read back at a time
READ_DOCS = 4096

_HEADER = "<4sBqq"  # magic, bytes per id, documents, of these without id
_MAGIC = b"TIF1"
_PUNCTUATION = b"!\"#$%&'()*+,-./:;=?@[\\]^_`{}~"


def place(folder: str) -> tuple[fs.FileSystem, str]:
    """The file system and path of a folder's name."""
    if "://" not in folder and folder.startswith("file:"):
        return fs.LocalFileSystem(), folder.removeprefix("file:")
    if "://" not in folder:
        return fs.LocalFileSystem(), os.path.abspath(folder)
    return fs.FileSystem.from_uri(folder)


class WordEncoder:
    """Encodes texts word by word with a tokenizer that never joins across white space, remembering each word's ids.

    A word's trailing ASCII punctuation is a token group of its own for the tokenizer, so the word is remembered without
    it: "word", "word," and "word." share an entry. Words with ``<`` or ``>`` may hold special tokens and are encoded as
    they are.
    """

    def __init__(self, tokenizer_file: str, remembered: int = REMEMBERED):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_file)
        self.width = 2 if self.tokenizer.get_vocab_size(with_added_tokens=True) <= 65536 else 4
        self.type = np.dtype(f"<u{self.width}")
        self.remembered = remembered
        self.whole: dict[bytes, bytes] = {}
        self.parts: dict[bytes, bytes] = {}

    def _encode(self, words: list[bytes]) -> list[bytes]:
        """The ids of each word, encoded independently of the others."""
        found = self.tokenizer.encode(
            [word.decode("utf-8", "replace") for word in words], is_pretokenized=True, add_special_tokens=False
        )
        ids = np.array(found.ids, self.type)
        owner = np.array([-1 if w is None else w for w in found.word_ids], np.int64)
        cuts = np.searchsorted(owner, np.arange(len(words) + 1))
        data, width = ids.tobytes(), self.width
        return [data[cuts[i] * width : cuts[i + 1] * width] for i in range(len(words))]

    @staticmethod
    def _split(word: bytes) -> tuple[bytes, bytes]:
        if b"<" in word or b">" in word:
            return word, b""
        core = word.rstrip(_PUNCTUATION)
        if not core or core == word:
            return word, b""
        # the tokenizer composes and lower-cases first; only a Latin letter is sure to end the token group
        last = unicodedata.normalize("NFC", core.decode("utf-8", "replace")).lower()[-1]
        if not (last.isalpha() and last < "\u0250"):
            return word, b""
        return core.lower(), word[len(core) :]

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """The ids of each text as packed integers."""
        if len(self.whole) > self.remembered:
            self.whole.clear()
        if len(self.parts) > self.remembered:
            self.parts.clear()
        split = [text.split() for text in texts]
        fresh = set()
        for words in split:
            fresh.update(words)
        fresh -= self.whole.keys()
        if fresh:
            cut = {word: self._split(word) for word in fresh}
            unknown = list({part for pair in cut.values() for part in pair if part} - self.parts.keys())
            for at in range(0, len(unknown), 20_000):
                some = unknown[at : at + 20_000]
                self.parts.update(zip(some, self._encode(some), strict=True))
            parts = self.parts
            for word, (core, rest) in cut.items():
                self.whole[word] = parts[core] + parts[rest] if rest else parts[core]
        known = self.whole.__getitem__
        return [b"".join(map(known, words)) for words in split]


def encoder(tokenizer_file: str) -> WordEncoder:
    """One encoder per worker process; what it remembers serves all tasks."""
    return of_worker(("words", tokenizer_file), lambda: WordEncoder(tokenizer_file))


def write_shards(docs: DataFrame, tokenizer_file: str, folder: str, end_id: int = END_ID, shards: int | None = None) -> DataFrame:
    """Write the token files; the result is the manifest: shard, n_docs, n_tokens. ``docs``: doc_id, body.

    ``shards``: how many range partitions; by default the session's number of shuffle partitions.
    """
    ship(docs.sparkSession)
    parts = docs.repartitionByRange(shards, "doc_id") if shards else docs.repartitionByRange("doc_id")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        name, mine = f"shard-{task.partitionId():06d}", f".{task.taskAttemptId()}"
        files, path = place(folder)
        coder = encoder(tokenizer_file)
        end = np.array([end_id], coder.type).tobytes()
        keys, sizes, out = [], [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            if out is None:
                files.create_dir(path, recursive=True)
                out = files.open_output_stream(f"{path}/{name}.ids{mine}")
            keys.append(batch.column("doc_id"))
            # a few thousand documents at a time bound what is held besides the batch
            body = batch.column("body")
            for at in range(0, len(body), READ_DOCS):
                coded = coder.encode(texts_of(body.slice(at, READ_DOCS)))
                sizes.append(np.fromiter(map(len, coded), np.int64, len(coded)) // coder.width + 1)
                out.write(end.join(coded) + end)
        if out is None:
            return
        out.close()
        ids = pa.chunked_array(keys)
        nulls = ids.null_count
        bounds = np.concatenate(([0], np.cumsum(np.concatenate(sizes))))
        known = ids.drop_null().to_numpy().astype(np.int64)
        head = struct.pack(_HEADER, _MAGIC, coder.width, len(ids), nulls)
        with files.open_output_stream(f"{path}/{name}.ef{mine}") as index:
            index.write(head + EliasFano.encode(bounds).to_bytes() + EliasFano.encode(known).to_bytes())
        for suffix in (".ids", ".ef"):
            files.move(f"{path}/{name}{suffix}{mine}", f"{path}/{name}{suffix}")
        yield pa.RecordBatch.from_pydict({"shard": [name], "n_docs": [len(ids)], "n_tokens": [int(bounds[-1])]})

    ordered = parts.sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "body")
    return written(ordered.mapInArrow(write, "shard string, n_docs long, n_tokens long"), "token-manifest")


class Shard:
    """A shard opened for reading."""

    def __init__(self, folder: str, name: str):
        self.files, path = place(folder)
        with self.files.open_input_stream(f"{path}/{name}.ef") as stream:
            data = stream.read()
        magic, self.width, self.count, self.nulls = struct.unpack_from(_HEADER, data)
        if magic != _MAGIC:
            raise ValueError(f"{name}.ef is no token index")
        self.bounds, at = EliasFano.from_bytes(data, struct.calcsize(_HEADER))
        self.keys, _ = EliasFano.from_bytes(data, at)
        self.path = f"{path}/{name}.ids"

    def doc_ids(self, first: int, last: int) -> list[int | None]:
        nulls = max(0, min(last, self.nulls) - first)
        return [None] * nulls + self.keys.slice(max(0, first - self.nulls), max(0, last - self.nulls)).tolist()

    def tokens(self, first: int, last: int) -> tuple[np.ndarray, np.ndarray]:
        """The boundaries of some documents, and their ids."""
        bounds = self.bounds.slice(first, last + 1)
        with self.files.open_input_file(self.path) as file:
            data = file.read_at(int(bounds[-1] - bounds[0]) * self.width, int(bounds[0]) * self.width)
        return bounds, np.frombuffer(data, f"<u{self.width}")


def read_shards(manifest: DataFrame, folder: str) -> DataFrame:
    """A row per document from the files: doc_id, start, n_tokens, ids_crc32."""
    spark = manifest.sparkSession
    start, rows = 0, []
    for row in manifest.orderBy("shard").collect():  # a row per shard
        rows.append((row.shard, start))
        start += row.n_tokens
    names = spark.createDataFrame(rows, "shard string, before long")
    names = names.repartition(max(1, len(rows)))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, before in zip(batch.column("shard").to_pylist(), batch.column("before").to_pylist(), strict=True):
                shard = Shard(folder, name)
                for first in range(0, shard.count, READ_DOCS):
                    last = min(shard.count, first + READ_DOCS)
                    bounds, ids = shard.tokens(first, last)
                    wide = ids.astype("<u4")
                    cuts = bounds - bounds[0]
                    crc = [zlib.crc32(wide[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
                    yield pa.RecordBatch.from_pydict(
                        {
                            "doc_id": pa.array(shard.doc_ids(first, last), pa.int64()),
                            "start": pa.array(bounds[:-1] + before),
                            "n_tokens": pa.array(np.diff(bounds)),
                            "ids_crc32": pa.array(crc, pa.int64()),
                        }
                    )

    return names.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_files(
    docs: DataFrame,
    tokenizer_file: str,
    folder: str | None = None,
    doc_id: str = "doc_id",
    text: str = "text",
    end_id: int = END_ID,
    shards: int | None = None,
) -> DataFrame:
    """Write the token files of ``docs`` to ``folder`` and read them back."""
    folder = folder or new_folder(docs.sparkSession, "tokens")
    rows = input_columns(docs, doc_id=doc_id, body=text)
    rows = rows.select(F.col("doc_id").cast("long").alias("doc_id"), utf8("body").alias("body"))
    return read_shards(write_shards(rows, tokenizer_file, folder, end_id, shards), folder)


def op9(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_files(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
