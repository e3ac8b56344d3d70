"""Secret scans: fixed patterns, and strings whose characters are as mixed as those of keys.

Beside the patterns, a candidate is a run of 20 or more characters of [A-Za-z0-9+/_=-] that holds a digit and a letter.
A window of WINDOW characters slides over it; the Shannon entropy of the window's characters is kept up to date from the
counts of the one that leaves and the one that enters. Windows at or over the bound of the candidate's character class
(hex, lower or upper case with digits, or mixed) are busy, unless they touch what the allow-list knows: UUIDs and
stand-ins such as `example`. Merged busy windows lose the plain words (of a path, a slug) at either end; what is left
makes a span of kind `entropy` if a busy window lies in it. So a word in a run never hides a key beside it.

Nulls count as empty: no spans. Each text is scanned once from left to right, so long runs of one character cost no more
than other text. Repeated rows each get their row; extra columns, whatever their names, are left as they are.
"""

from __future__ import annotations

import hashlib
import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import by_batch, by_whole_rows, documents, no_clash

KINDS = ("assign", "access", "hex", "entropy")
KEYWORDS = ("password", "passwd", "secret", "token", "api")
ASSIGN = re.compile(r"""(?ia:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{20,}")

WINDOW = 20
#: Bits a character at which a window counts, by class.
BOUNDS = {"hex": 2.9, "one_case": 3.4, "mixed": 3.7}
#: The allow-list: UUIDs and stand-ins.
ALLOWED = re.compile(r"[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}|EXAMPLE|[Ee]xample|[Pp]laceholder|[xX]{6,}")
PART = re.compile(r"[^-_/=+]+")
HUMP = re.compile(r"[A-Z]+[a-z]*+|[a-z]+")
BITS = [0.0] + [c * math.log2(c) for c in range(1, WINDOW + 1)]


def char_class(s: str) -> str:
    if re.fullmatch(r"[0-9a-f]+|[0-9A-F]+", s):
        return "hex"
    return "mixed" if re.search("[a-z]", s) and re.search("[A-Z]", s) else "one_case"


def busy_windows(s: str, bound: float) -> list[tuple[int, int]]:
    """Merged windows of s whose entropy is at or over the bound and that touch nothing of the allow-list."""
    count: dict[str, int] = {}
    total, spans = 0.0, []
    allowed, free = ALLOWED.finditer(s), 0
    nxt = next(allowed, None)
    for i, c in enumerate(s):
        if i >= WINDOW:
            old = s[i - WINDOW]
            k = count[old]
            total += BITS[k - 1] - BITS[k]
            count[old] = k - 1
        k = count.get(c, 0)
        total += BITS[k + 1] - BITS[k]
        count[c] = k + 1
        if nxt is not None and i >= nxt.start():
            free = nxt.end()
            if i + 1 >= free:
                nxt = next(allowed, None)
        lo = i - WINDOW + 1
        if lo >= free and math.log2(WINDOW) - total / WINDOW >= bound - 1e-9:
            if spans and lo <= spans[-1][1]:
                spans[-1] = (spans[-1][0], i + 1)
            else:
                spans.append((lo, i + 1))
    return spans


def is_plain(part: str) -> bool:
    """A short part, or words of three letters or more on average with a small number behind them."""
    letters = part.rstrip("0123456789")
    if len(part) <= 4:
        return True
    return len(part) - len(letters) <= 4 and letters.isalpha() and len(letters) >= 3 * len(HUMP.findall(letters))


def core(s: str) -> tuple[int, int]:
    """s without plain parts at either end."""
    lo, hi = len(s), 0
    for m in PART.finditer(s):
        if not is_plain(m[0]):
            lo, hi = min(lo, m.start()), m.end()
    return lo, hi


def find(text: str | None) -> list[tuple[int, int, int]]:
    """(start, kind number, end), sorted."""
    if not text:
        return []
    low = text.lower()
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8] if any(k in low for k in KEYWORDS) else []
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    base = sorted(found)
    nth, reach = 0, 0
    for m in CANDIDATE.finditer(text):
        s = m[0]
        if not re.search("[0-9]", s) or not re.search("[A-Za-z]", s):
            continue
        bound = BOUNDS[char_class(s)]
        for lo, hi in busy_windows(s, bound):
            a, b = core(s[lo:hi])
            if b - a < WINDOW or (b - a < hi - lo and not busy_windows(s[lo + a : lo + b], bound)):
                continue
            a, b = m.start() + lo + a, m.start() + lo + b
            while nth < len(base) and base[nth][0] <= a:
                reach = max(reach, base[nth][2])
                nth += 1
            if b > reach:
                found.append((a, 3, b))
    return sorted(found)


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def redacted(text: str, spans: list[tuple[int, int, int]], mark: str) -> str:
    """The text with each stretch of overlapping spans replaced."""
    out, at = [], 0
    for a, _, b in spans:
        if a >= at:
            out += [text[at:a], mark]
        at = max(at, b)
    return "".join([*out, text[at:]])


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_entropy for each row."""

    def work(ids: list, texts: list) -> dict:
        out: dict = {"doc_id": ids, "n_assign": [], "n_access": [], "n_hex": [], "base_sha256": [], "spans": [], "n_entropy": []}
        for t in texts:
            spans = find(t)
            for k, name in enumerate(KINDS):
                out[f"n_{name}"].append(sum(x[1] == k for x in spans))
            out["base_sha256"].append(hashlib.sha256(joined([x for x in spans if x[1] < 3]).encode()).hexdigest())
            out["spans"].append(joined(spans))
        return out

    return by_batch(no_clash(docs, "doc_id", "text"), ["doc_id", "text"], work, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_entropy long")


def redact(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """docs with secrets in text replaced by a mark, and n_chars, where there is one, brought up to date. A null text stays null."""
    at, counted = docs.columns.index("text"), docs.columns.index("n_chars") if "n_chars" in docs.columns else None

    def change(batch: pa.RecordBatch, texts: list) -> pa.RecordBatch:
        clean = [t if t is None else redacted(t, find(t), mark) for t in texts]
        out = batch.set_column(at, batch.schema.field(at), pa.array(clean, batch.schema.field(at).type))
        if counted is not None:
            kind = batch.schema.field(counted).type
            sizes = [n if t is None else len(t) for t, n in zip(clean, batch.column(counted).to_pylist(), strict=True)]
            out = out.set_column(counted, batch.schema.field(counted), pa.array(sizes).cast(kind))
        return out

    return by_whole_rows(docs, change)


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(documents(spark, sf_dir))
