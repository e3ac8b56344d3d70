"""Language identification by cross-parsing entropy.

For each language a suffix automaton is built over labelled text. A text is parsed by each: the longest stretch that
occurs in the sample is a phrase, then the next begins. Few phrases mean that the text is made of the language's own long
stretches; phrases, times the bits that name a place in the sample, estimate the cross entropy, and the language with the
least wins (the first by name on a tie).

The parse is over classes of UTF-8 bytes (letters without case, digits, all else as one space), from a text's first
symbol to its last. Blocks of a long text are parsed side by side from a guessed start; then each is parsed again from
where the block before really left off, until it meets a phrase of its first parse, from where on both agree. What comes
out is the plain parse, whatever the length.

Teaching rows, of each language: whole texts, distinct ones (copies count once), SAMPLE_DOCS at most, by their hash; texts
of up to LONG characters come first, and of longer ones the shorter, until TEACH_CHARS (TEACH_TOTAL over the number of
languages, if that is less) would be passed; the first is taken in any case. No text is cut. Rows with a null lang or text
teach nothing.

A text that is null or has no letter gives `und` with score 0; with no language learned, all do. Repeated rows each get
their row; extra columns, whatever their names, are left as they are.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import by_batch, by_whole_rows, documents, id_crc, no_clash, stored

SAMPLE_DOCS, LONG, TEACH_CHARS, TEACH_TOTAL = 40, 4_000, 100_000, 4_000_000
#: Symbols of a block, and how often blocks are parsed side by side before the rest is parsed one by one.
BLOCK, ROUNDS = 512, 4
UND = "und"
LETTER = regex.compile(r"\p{L}")


def byte_classes() -> np.ndarray:
    """Class of each byte: 0 for all that is neither letter nor digit, 1 for digits, one for each letter and high byte."""
    out = np.zeros(256, np.uint8)
    out[48:58] = 1
    for i in range(26):
        out[65 + i] = out[97 + i] = 2 + i
    for i, b in enumerate(range(0x80, 0xA0)):  # second bytes: capitals are 32 below small letters in Latin-1
        out[b] = out[b + 32] = 28 + i
    for i, b in enumerate(range(0xC0, 0x100)):
        out[b] = 60 + i % 32
    return out


#: The last class is no byte's: it stands behind each text, and nothing goes on with it.
CLASSES, N_CLASSES, END = byte_classes(), 93, 92


def symbols(data: np.ndarray) -> np.ndarray:
    """Classes of bytes, with runs of class 0 as one."""
    c = CLASSES[data]
    return c[np.concatenate([[True], (c[1:] != 0) | (c[:-1] != 0)])] if len(c) else c


def suffix_automaton(seq: list[int]) -> list[dict[int, int]]:
    """Transitions by state (the first is the start) of the automaton of all stretches of seq."""
    to: list[dict[int, int]] = [{}]
    link, size, last = [-1], [0], 0
    for c in seq:
        cur = len(to)
        to.append({})
        size.append(size[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in to[p]:
            to[p][c] = cur
            p = link[p]
        if p >= 0:
            q = to[p][c]
            if size[q] == size[p] + 1:
                link[cur] = q
            else:
                twin = len(to)
                to.append(dict(to[q]))
                size.append(size[p] + 1)
                link.append(link[q])
                while p >= 0 and to[p].get(c) == q:
                    to[p][c] = twin
                    p = link[p]
                link[q] = link[cur] = twin
        last = cur
    return to


@dataclass(frozen=True)
class Model:
    """An automaton in two rows: a state is a number, and its step by class c is at state + c, if that place is its own."""

    lang: str
    owner: np.ndarray
    target: np.ndarray
    anew: np.ndarray
    bits: float

    @classmethod
    def of(cls, lang: str, text: str) -> Model:
        seq = symbols(np.frombuffer(text.encode("utf-8", "replace"), np.uint8))
        owner, target = packed_rows(suffix_automaton(seq.tolist()))
        # The start state is number 0; after a failed step a phrase begins with the symbol that failed. One that the
        # sample lacks is a phrase of its own: the state behind the last has no steps.
        first = np.where(owner[:N_CLASSES] == 0, target[:N_CLASSES], len(owner)).astype(np.int32)
        owner, target = (np.concatenate([x, np.full(N_CLASSES, -1, np.int32)]) for x in (owner, target))
        return cls(lang, owner, target, first, float(np.log2(max(2, len(seq)))))


def packed_rows(to: list[dict[int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Lay the states' transitions into one row so that no two use a place; wide states first, each from where the last of its width fitted."""
    room = 4 * sum(map(len, to)) + 4 * len(to) + 2 * N_CLASSES + 64
    taken, used, place = bytearray(room), bytearray(room), [0] * len(to)
    start = [0] * (N_CLASSES + 1)
    for s in [0, *sorted(range(1, len(to)), key=lambda s: -len(to[s]))]:
        cs = list(to[s])
        first = cs[0] if cs and s else 0
        # `spot` is where the first transition goes; the state's number is spot - first.
        spot = first if not s else max(start[len(cs)], first)
        while (cs and taken[spot]) or used[spot - first] or any(taken[spot - first + c] for c in cs):
            spot = taken.find(0, spot + 1) if cs else spot + 1
            if spot < 0:
                spot = len(taken)
            if spot + N_CLASSES >= len(taken):
                taken.extend(bytes(room))
                used.extend(bytes(room))
        start[len(cs)], place[s] = spot, spot - first
        used[spot - first] = 1
        for c in cs:
            taken[spot - first + c] = 1
    end = max(place) + N_CLASSES + 1
    owner, target = np.full(end, -1, np.int32), np.zeros(end, np.int32)
    for s, row in enumerate(to):
        for c, t in row.items():
            owner[place[s] + c], target[place[s] + c] = place[s], place[t]
    return owner, target


def first_parse(flat: np.ndarray, model: Model, at: np.ndarray, end: np.ndarray, marks: np.ndarray) -> np.ndarray:
    """Parse each lane as if a phrase began at its start: marks within, then where it leaves off behind its end."""
    order = np.argsort(at - end, kind="stable")
    start, size = at[order], (end - at)[order]
    place = start[None, :] + np.arange(size[0])[:, None]
    chars = np.ascontiguousarray(flat[np.minimum(place, len(flat) - 1)])
    fails = np.zeros(chars.shape, bool)
    fails[0] = True
    state = model.anew[chars[0]]
    for k, n in enumerate(np.searchsorted(-size, -np.arange(1, size[0]), side="left"), start=1):
        c, now = chars[k, :n], state[:n]
        slot = now + c
        fail = model.owner[slot] != now
        state[:n] = np.where(fail, model.anew[c], model.target[slot])
        fails[k, :n] = fail
    within = np.arange(size[0])[:, None] < size
    marks[place[within]] = fails[within]
    out = np.empty(len(at), np.int64)
    out[order] = go_on(flat, model, state, start + size)
    return out


def go_on(flat: np.ndarray, model: Model, state: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Where the phrases that are under way end."""
    out, lane = np.empty(len(p), np.int64), np.arange(len(p))
    while len(lane):
        slot = state + flat[p]
        fail = model.owner[slot] != state
        out[lane[fail]] = p[fail]
        keep = ~fail
        lane, p, state = lane[keep], p[keep] + 1, model.target[slot[keep]]
    return out


def parse_again(flat: np.ndarray, model: Model, at: np.ndarray, end: np.ndarray, marks: np.ndarray) -> np.ndarray:
    """Parse from `at`, where a phrase begins, until a mark of the earlier parse is met, from where on it holds (-1), or past `end`."""
    out, lane = np.full(len(at), -1, np.int64), np.arange(len(at))
    marks[at] = True
    state, p = model.anew[flat[at]], at + 1
    while len(lane):
        over = p >= end
        if over.any():
            out[lane[over]] = go_on(flat, model, state[over], p[over])
            keep = ~over
            lane, p, end, state = lane[keep], p[keep], end[keep], state[keep]
        c = flat[p]
        slot = state + c
        fail = model.owner[slot] != state
        met = fail & marks[p]
        marks[p] = fail
        keep = ~met
        state = np.where(fail, model.anew[c], model.target[slot])[keep]
        lane, p, end = lane[keep], p[keep] + 1, end[keep]
    return out


def run_one(flat: np.ndarray, model: Model, at: int, stop: int, marks: np.ndarray) -> None:
    """The plain parse of one stretch."""
    owner, target, anew, chars, mark = memoryview(model.owner), memoryview(model.target), memoryview(model.anew), memoryview(flat), memoryview(marks)
    mark[at] = True
    state = anew[chars[at]]
    for p in range(at + 1, stop):
        c = chars[p]
        slot = state + c
        fail = owner[slot] != state
        mark[p] = fail
        state = anew[c] if fail else target[slot]


def phrases(flat: np.ndarray, sizes: np.ndarray, model: Model) -> np.ndarray:
    """Phrases of each text (texts of one symbol or more, laid end to end with END behind each)."""
    stop_of = np.cumsum(sizes + 1) - 1
    per = -(-sizes // BLOCK)
    text = np.repeat(np.arange(len(sizes)), per)
    first = np.concatenate([[True], text[1:] != text[:-1]])
    nth = np.arange(len(text)) - np.repeat(np.cumsum(per) - per, per)
    at = (stop_of - sizes)[text] + nth * BLOCK
    stop = stop_of[text]
    end = np.minimum(at + BLOCK, stop)
    marks = np.zeros(len(flat) + 1, bool)
    entry = at.copy()
    left = first_parse(flat, model, at, end, marks)
    for turn in range(ROUNDS + 1):
        wanted = np.where(first, at, np.concatenate([[0], left[:-1]]))
        again = np.flatnonzero(wanted != entry)
        if not len(again):
            break
        if turn == ROUNDS:
            for k in again[np.concatenate([[True], text[again][1:] != text[again][:-1]])]:
                marks[at[k] : wanted[k]] = False
                if wanted[k] < stop[k]:
                    run_one(flat, model, int(wanted[k]), int(stop[k]), marks)
            break
        entry[again] = wanted[again]
        gap = np.minimum(wanted[again], end[again]) - at[again]
        marks[np.repeat(at[again], gap) + np.arange(gap.sum()) - np.repeat(np.cumsum(gap) - gap, gap)] = False
        within = wanted[again] < end[again]
        left[again[~within]] = wanted[again[~within]]
        new = again[within]
        new = new[~marks[entry[new]]]
        got = parse_again(flat, model, entry[new], end[new], marks)
        left[new[got >= 0]] = got[got >= 0]
    return np.add.reduceat(marks[:-1].astype(np.int64), stop_of - sizes)


def laid(seqs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Texts end to end, END behind each, and their sizes."""
    behind = np.array([END], np.uint8)
    return np.concatenate([x for s in seqs for x in (s, behind)]), np.array([len(s) for s in seqs], np.int64)


def classify(texts: list[str | None], models: list[Model]) -> tuple[list[str], list[float]]:
    at = [i for i, t in enumerate(texts) if t and models and LETTER.search(t)]
    langs, scores = [UND] * len(texts), [0.0] * len(texts)
    if not at:
        return langs, scores
    seqs = [symbols(np.frombuffer(texts[i].encode("utf-8", "replace"), np.uint8)) for i in at]
    flat, sizes = laid(seqs)
    costs = np.stack([m.bits * phrases(flat, sizes, m) for m in models])
    low = costs.min(axis=0)
    others = np.sort(costs, axis=0)[1] if len(models) > 1 else low * 2
    for i, best, x, y in zip(at, costs.argmin(axis=0).tolist(), low.tolist(), others.tolist(), strict=True):
        langs[i], scores[i] = models[best].lang, 1 - x / y if y > 0 else 0.0
    return langs, scores


def teaching(train: DataFrame) -> DataFrame:
    """lang, h, text of the teaching rows."""
    rows = no_clash(train, "text", "lang").where("lang is not null and length(text) > 0").select("lang", F.xxhash64("text").alias("h"), F.length("text").alias("n"), "text")
    # Of the distinct texts of a language some 16 times as many as are wanted, by hash: all tasks find them without a sort.
    share = stored(rows.groupBy("lang").agg(F.approx_count_distinct("h").alias("texts")).select("lang", F.least(F.lit(1.0), 16 * SAMPLE_DOCS / F.col("texts")).alias("share")))
    most = min(TEACH_CHARS, TEACH_TOTAL // max(1, share.count()))
    some = rows.select("lang", "h", "n").join(F.broadcast(share), "lang").where(F.pmod("h", F.lit(1 << 30)) < F.col("share") * (1 << 30)).groupBy("lang", "h").agg(F.min("n").alias("n"))
    by = Window.partitionBy("lang").orderBy(F.greatest("n", F.lit(LONG)), "h")
    ranked = some.withColumn("nth", F.row_number().over(by)).withColumn("upto", F.sum("n").over(by.rowsBetween(Window.unboundedPreceding, 0)))
    picked = ranked.where((F.col("nth") <= SAMPLE_DOCS) & ((F.col("upto") <= most) | (F.col("nth") == 1))).select("lang", "h")
    return rows.select("lang", "h", "text").join(F.broadcast(picked), ["lang", "h"]).groupBy("lang", "h").agg(F.min("text").alias("text"))


def learn(train: DataFrame) -> list[Model]:
    """A model for each language of rows with text and lang, by name; built on executors, bounded by TEACH_TOTAL."""

    def build(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        m = Model.of(key[0], " ".join(rows.sort_values("h")["text"]))
        return pd.DataFrame({"lang": [m.lang], "owner": [m.owner.tobytes()], "target": [m.target.tobytes()], "anew": [m.anew.tobytes()], "bits": [m.bits]})

    made = teaching(train).groupBy("lang").applyInPandas(build, "lang string, owner binary, target binary, anew binary, bits double").collect()
    as_row = lambda b: np.frombuffer(b, np.int32)
    return [Model(r.lang, as_row(r.owner), as_row(r.target), as_row(r.anew), r.bits) for r in sorted(made, key=lambda r: r.lang)]


def held_out(docs: DataFrame):  # noqa: ANN201
    """crc32 of the id modulo 4 is 2; such rows teach nothing. False for a null id."""
    return F.coalesce(id_crc(docs["doc_id"], 4) == 2, F.lit(False))


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score for each row."""
    models = docs.sparkSession.sparkContext.broadcast(learn(docs.where(~held_out(docs))))

    def work(ids: list, texts: list) -> dict:
        langs, scores = classify(texts, models.value)
        return {"doc_id": ids, "lang_pred": langs, "score": scores}

    out = by_batch(no_clash(docs, "doc_id", "text"), ["doc_id", "text"], work, "doc_id long, lang_pred string, score double")
    return out.select("doc_id", held_out(out).alias("held_out"), "lang_pred", "score")


def keep_known(docs: DataFrame) -> DataFrame:
    """docs without those whose language can't be told."""
    models = docs.sparkSession.sparkContext.broadcast(learn(docs.where(~held_out(docs))))

    def change(batch: pa.RecordBatch, texts: list) -> pa.RecordBatch:
        return batch.filter(pa.array([x != UND for x in classify(texts, models.value)[0]]))

    return by_whole_rows(docs, change)


def op9_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(documents(spark, sf_dir))
