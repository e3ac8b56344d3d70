"""Byte-level BPE by dynamic programming over prefixes, exact to the ids of the tokenizer file.

Every prefix of a piece of text has one last token under BPE. A token that ends a prefix is that last token if it stands
alone, or if it is compatible with the last token of the prefix before it: the two, encoded together, stay two. The
suffix-link automaton of the vocabulary reports the tokens that end at each place; following the last tokens back from
the end gives the ids.

Texts are cut before a single space between two non-space characters, where the splitting pattern always cuts; pieces
and their ids are remembered in tables of bounded size. Texts with other white space go through the pattern as a whole.

Nulls count as empty: no ids, an empty decoded text. Repeated rows each get their row; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
from functools import lru_cache

import ahocorasick
import numpy as np
import regex
from pyspark.sql import DataFrame, SparkSession

from .common import by_batch, documents, no_clash

#: Entries that a worker remembers at most, for each of its two tables; twice as many for pairs.
REMEMBERED = 300_000
#: The splitting pattern that byte-level vocabularies of this family are used with.
SPLIT_PLAIN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: The same for a library whose \s holds more than Unicode's White_Space.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in the file: itself if it prints, else the next one from U+0100."""
    prints = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = (b for b in range(256) if b not in prints)
    return {chr(b): b for b in prints} | {chr(256 + i): b for i, b in enumerate(others)}


class Bpe:
    """Encoder and decoder for one tokenizer file."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = byte_letters()
        raw = {name: bytes(letters[c] for c in name) for name in spec["model"]["vocab"]}
        self.bytes: dict[int, bytes] = {i: raw[name] for name, i in spec["model"]["vocab"].items()}
        ids = {b: i for i, b in self.bytes.items()}
        #: rank of the merge that makes a token (bytes have none), its two halves, and the token of each merge
        self.rank: dict[int, int] = {}
        self.halves: dict[int, tuple[int, int]] = {}
        self.merge: dict[tuple[int, int], int] = {}
        for r, m in enumerate(spec["model"]["merges"]):
            a, b = (raw[x] for x in (m if isinstance(m, list) else m.split(" ")))
            pair, made = (ids[a], ids[b]), ids[a + b]
            self.merge[pair] = r
            if made not in self.rank:
                self.rank[made], self.halves[made] = r, pair
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.bytes |= {i: s.encode() for s, i in self.special.items()}
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.automaton = ahocorasick.Automaton()
        for b, i in ids.items():
            self.automaton.add_word(b.decode("latin-1"), (i, len(b)))
        self.automaton.make_automaton()
        self.split = regex.compile(SPLIT)
        self.pairs: dict[int, bool] = {}
        self.alone: dict[int, bool] = {}
        self.known: dict[str, bytes] = {}
        self.chunks = _Chunks(self)

    def compatible(self, a: int, b: int) -> bool:
        """Whether encoding a's and b's bytes together gives a, b."""
        pair = a << 32 | b
        if (known := self.pairs.get(pair)) is None:
            if len(self.pairs) >= 2 * REMEMBERED:
                self.pairs.clear()
            known = self.pairs[pair] = self._stays(a, b)
        return known

    def _stays(self, a: int, b: int) -> bool:
        # Undo the merges within a and b, the latest first: what then touches at the seam must not merge before
        # the step that was undone. A merge within a comes first on equal ranks, as it is on the left.
        rank, halves, merge = self.rank, self.halves, self.merge
        before, strict = 1 << 60, True
        while True:
            r = merge.get((a, b))
            if r is not None and (r < before or (r == before and not strict)):
                return False
            ra, rb = rank.get(a, -1), rank.get(b, -1)
            if ra < 0 and rb < 0:
                return True
            if ra > rb:
                before, strict, a = ra, True, halves[a][1]
            else:
                before, strict, b = rb, False, halves[b][0]

    def stands(self, t: int) -> bool:
        """Whether the token's own bytes encode to it."""
        if (known := self.alone.get(t)) is None:
            h = self.halves.get(t)
            known = self.alone[t] = h is None or (self.stands(h[0]) and self.stands(h[1]) and self.merges_of(self.bytes[t]) == [t])
        return known

    def merges_of(self, piece: bytes) -> list[int]:
        """Ids by merging, the lowest rank first: the definition, for checks."""
        ids = [self._of_byte(b) for b in piece]
        while len(ids) > 1:
            r, i = min((self.merge.get(p, 1 << 60), i) for i, p in enumerate(zip(ids, ids[1:], strict=False)))
            if r == 1 << 60:
                break
            ids[i : i + 2] = [self._made[r]]
        return ids

    @property
    def _made(self) -> dict[int, int]:
        if not hasattr(self, "_made_by"):
            self._made_by = {r: t for t, r in self.rank.items()}
            ids = {b: i for i, b in self.bytes.items()}
            self._made_by |= {r: ids[self.bytes[a] + self.bytes[b]] for (a, b), r in self.merge.items()}
        return self._made_by

    def _of_byte(self, b: int) -> int:
        if not hasattr(self, "_byte_ids"):
            self._byte_ids = {v[0]: i for i, v in self.bytes.items() if len(v) == 1}
        return self._byte_ids[b]

    def encode_piece(self, piece: str) -> list[int]:
        """Ids of one piece that the splitting pattern gave."""
        text = piece.encode("utf-8", "replace").decode("latin-1")
        last: list[int] = [-1] * (len(text) + 1)
        size = [0] * (len(text) + 1)
        for end, (token, n) in self.automaton.iter(text):
            if last[end + 1] < 0:
                start = end + 1 - n
                if self.stands(token) if start == 0 else self.compatible(last[start], token):
                    last[end + 1], size[end + 1] = token, n
        ids, at = [], len(text)
        while at:
            ids.append(last[at])
            at -= size[at]
        return ids[::-1]

    def of_pieces(self, text: str) -> bytes:
        known, out = self.known, []
        for p in self.split.findall(text):
            ids = known.get(p)
            if ids is None:
                ids = np.array(self.encode_piece(p), "<u4").tobytes()
                if len(p) < 64:
                    if len(known) >= REMEMBERED:
                        known.clear()
                    known[p] = ids
            out.append(ids)
        return b"".join(out)

    def _plain(self, text: str) -> bytes:
        head, *rest = text.split(" ")
        try:
            return b"".join([self.chunks[head], *map(self.chunks.__getitem__, [" " + x for x in rest])])
        except _OtherSpace:
            return self.of_pieces(text)

    def encode(self, text: str | None) -> bytes:
        """The ids of a text, little-endian unsigned 32-bit."""
        if not text:
            return b""
        if self.cut is None or not any(s in text for s in self.special):
            return self._plain(text)
        parts = self.cut.split(text)
        return b"".join(np.array([self.special[p]], "<u4").tobytes() if i % 2 else self._plain(p) if p else b"" for i, p in enumerate(parts))

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.bytes.__getitem__, ids)).decode("utf-8", "replace")


class _OtherSpace(Exception):
    """White space beside a cut: the cut may not be one of the pattern's."""


class _Chunks(dict):
    """Ids by chunk: text between two cuts, the space at the front."""

    def __init__(self, bpe: Bpe) -> None:
        super().__init__()
        self.bpe = bpe

    def __missing__(self, chunk: str) -> bytes:
        body = chunk[1:] if chunk[:1] == " " else chunk
        if not body or body[0].isspace() or body[-1].isspace():
            raise _OtherSpace
        ids = self.bpe.of_pieces(chunk)
        if len(chunk) < 64:
            if len(self) >= REMEMBERED:
                self.clear()
            self[chunk] = ids
        return ids


@lru_cache(maxsize=2)
def bpe(path: str) -> Bpe:
    """One for each worker process and file."""
    return Bpe(path)


def encode_decode(docs: DataFrame, path: str | None = None, keep: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of each row; with keep also ids and decoded."""
    path = path or default_vocabulary()

    def work(ids: list, texts: list) -> dict:
        b = bpe(path)
        names = [str(i) for i in range(max(b.bytes) + 1)]
        out: dict = {"doc_id": ids, "n_tokens": [], "ids_sha256": [], "decoded_sha256": [], "ids": [], "decoded": []}
        for t in texts:
            got = np.frombuffer(b.encode(t), "<u4").tolist()
            back = b.decode(got)
            out["n_tokens"].append(len(got))
            out["ids_sha256"].append(hashlib.sha256(",".join(map(names.__getitem__, got)).encode()).hexdigest())
            out["decoded_sha256"].append(hashlib.sha256(back.encode("utf-8", "replace")).hexdigest())
            if keep:
                out["ids"].append(got)
                out["decoded"].append(back)
        return out

    return by_batch(no_clash(docs, "doc_id", "text"), ["doc_id", "text"], work, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>, decoded string" * keep)


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_decode(documents(spark, sf_dir))
