"""Packing by power-of-two decomposition.

A document's ids and its end id are cut into as many whole sequences as fit and, of the rest, one piece for each bit of
its length, the longest first. Each piece is a sequence of its own whose length is a power of two: no sequence crosses
documents and none is padded. Equal lengths form a bucket: sequence ids are dealt bucket by bucket, and write_buckets()
lays a bucket's sequences out in files of their own, from which batches of one length are drawn.

Nulls count as empty: the end id alone. Texts of any length and of any white space are encoded whole. Repeated rows are
packed as rows of their own, with their own sequences. Extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import json
import zlib
from functools import lru_cache

import numpy as np
import regex
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import SPLIT_PLAIN, byte_letters, default_vocabulary
from .common import by_batch, documents, no_clash, stored

LENGTH, END_ID = 2048, 1


@lru_cache(maxsize=2)
def encoder(path: str) -> tuple[tiktoken.Encoding, set[str]]:
    """A fast encoder with the file's ids, which follow the order of its merges; one for each worker process."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    letters = byte_letters()
    ranks = {bytes(letters[c] for c in name): i for name, i in spec["model"]["vocab"].items()}
    special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
    ranks = {b: i for b, i in ranks.items() if i not in special.values()}
    return tiktoken.Encoding("file", pat_str=SPLIT_PLAIN, mergeable_ranks=ranks, special_tokens=special), set(special)


#: White space so long that the library's pattern can't take it in one go. The splitting pattern makes a run one piece,
#: less its last character where other text follows, and never joins a run with what stands before it.
LONG_SPACE = regex.compile(r"\p{White_Space}{64,}+")


def encoded(text: str, enc: tiktoken.Encoding, special: set[str]) -> list[int]:
    """Ids of a text. Long runs of white space are cut out where the pattern cuts anyway, and merged as the pieces they are."""
    if not LONG_SPACE.search(text):
        return enc.encode(text, allowed_special=special)
    out, at = [], 0
    for m in LONG_SPACE.finditer(text):
        hi = m.end() if m.end() == len(text) or any(text.startswith(s, m.end()) for s in special) else m.end() - 1
        out += enc.encode(text[at : m.start()], allowed_special=special)
        out += enc._core_bpe.encode_single_piece(m[0][: hi - m.start()].encode())
        at = hi
    return out + enc.encode(text[at:], allowed_special=special)


def cuts(n: int, longest: int = LENGTH) -> list[int]:
    """Piece lengths of n ids: whole sequences, then the set bits of the rest from the highest."""
    return [longest] * (n // longest) + [1 << b for b in range(longest.bit_length() - 2, -1, -1) if (n % longest) >> b & 1]


def pack(docs: DataFrame, path: str | None = None, longest: int = LENGTH, end_id: int = END_ID, keep: bool = False) -> DataFrame:
    """A row for each piece: doc_id, start, length (its bucket), ids_crc32, doc_tokens, sequence_id, offset; with keep also ids.

    longest must be a power of two, 1 << 12 at most. The pieces are stored before they are numbered, so that a task that
    is run again numbers the same rows. A sequence id has the bucket (the bits of the length) in its upper bits, then a
    number that no other sequence has.
    """
    if longest < 1 or longest & (longest - 1) or longest > 1 << 12:
        raise ValueError("longest must be a power of two, 4096 at most")
    path = path or default_vocabulary()
    end = end_id.to_bytes(4, "little")

    def work(ids: list, texts: list) -> dict:
        enc, special = encoder(path)
        out: dict = {"doc_id": [], "start": [], "length": [], "ids_crc32": [], "doc_tokens": [], "ids": []}
        for i, t in zip(ids, texts, strict=True):
            got = np.array(encoded(t or "", enc, special), "<u4").tobytes() + end
            n, at = len(got) // 4, 0
            for k in cuts(n, longest):
                piece = got[4 * at : 4 * (at + k)]
                out["doc_id"].append(i)
                out["start"].append(at)
                out["length"].append(k)
                out["ids_crc32"].append(zlib.crc32(piece))
                out["doc_tokens"].append(n)
                if keep:
                    out["ids"].append([int.from_bytes(piece[j : j + 4], "little") for j in range(0, len(piece), 4)])
                at += k
        return out

    pieces = stored(by_batch(no_clash(docs, "doc_id", "text"), ["doc_id", "text"], work, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long" + ", ids array<int>" * keep))
    # 33 bits number the rows of a task, those above them the task.
    bucket = sum(((F.col("length") > (1 << b)).cast("long") for b in range(12)), F.lit(0).cast("long"))
    return pieces.withColumn("sequence_id", bucket * (1 << 59) + F.monotonically_increasing_id()).withColumn("offset", F.lit(0).cast("long"))


#: Sequences of a bucket's file.
FILE_ROWS = 1 << 20


def write_buckets(pieces: DataFrame, path: str) -> None:
    """Lay sequences out by length, in path/length=N, so that a reader draws batches of one length.

    A bucket is dealt to tasks by sequence id, as many as it has FILE_ROWS, so neither the number of files nor a task
    grows with another bucket.
    """
    files = pieces.groupBy("length").agg(F.ceil(F.count("*") / FILE_ROWS).cast("int").alias("files"))
    dealt = pieces.join(F.broadcast(files), "length").withColumn("file", F.pmod(F.xxhash64("sequence_id"), F.col("files")).cast("int"))
    total = files.agg(F.coalesce(F.sum("files"), F.lit(1))).first()[0]
    dealt.repartition(int(total), "length", "file").drop("files", "file").write.partitionBy("length").parquet(path)


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(documents(spark, sf_dir))
