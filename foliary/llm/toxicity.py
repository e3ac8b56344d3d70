"""Toxicity by a weighted finite-state pattern grammar.

Tokens are classed as insult, threat, target, negation, reported speech, clause end or other; forms of several tokens
("according to", the "n't" of a contraction) become one by a small transducer. Transducers follow each of negation,
target, threat and report; their composition is one table from (state, class) to (state, factor). An insult adds its
weight times the factor of the state it is met in: less behind a negation or in reported speech, more beside a target; a
threat counts once a target is near. A clause is run from its first token to its last, however long it is. Clauses are
scored, not words alone.

Insults are learned: words and word beginnings that are much likelier in toxic documents, counted once for each group of
near-copies (documents with the same least word hash). Clause scores of a document become a few features, which a logistic
regression turns into a score; it is fitted on rows that the insults were not learned from.

Sample: the FIT_ROWS labelled training rows whose ids hash lowest; nothing else is gathered. Rows whose crc32(id) mod 5 is
0 teach nothing. Labels, lang, source and doc_id are no inputs.

A null or empty text gets the score of a text without matches. Without both labels in the sample every score is the share
of toxic rows, or 0. Repeated rows each get their row; extra columns are ignored.
"""

from __future__ import annotations

import itertools
import math
import re
import zlib
from dataclasses import dataclass, field

import numpy as np
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import by_batch, documents, id_crc, labels, no_clash, stored

FIT_ROWS, LEXICON, MIN_GROUPS, MIN_LIFT, BEGINNINGS = 6000, 1500, 3, 4.0, range(4, 9)

#: The token that stands for the n't of a contraction.
NOT = "\u0174t"

# Closed word classes of the grammar in English, French, German and Spanish; then forms of several tokens.
NEGATION = frozenset(f"{NOT} not no never neither nor none without cannot pas jamais aucun aucune ni sans rien nicht kein keine keinen keiner nie niemals ohne weder nunca tampoco ningún ninguna jamás sin".split())
REPORT = frozenset("said says say wrote writes quoted quotes claimed claims called calls alleged allegedly reportedly dit disait écrit selon prétend sagte sagt schrieb meinte laut angeblich dijo dice escribió llamó según".split())
TARGET = frozenset("you your yours he she they him her them tu toi vous ton ta votre du dich dir dein ihr euch usted ustedes tú ti tus".split())
THREAT = frozenset("kill hurt destroy beat shoot stab burn tuer frapper brûler töten schlagen verbrennen matar golpear quemar".split())
FORMS = {
    ("according", "to"): "said", ("so", "called"): "said", ("in", "the", "words", "of"): "said", ("a", "dit"): "said", ("soi", "disant"): "said", ("so", "genannt"): "said", ("de", "acuerdo", "con"): "said",
    ("far", "from"): "not", ("by", "no", "means"): "not", ("anything", "but"): "not", ("loin", "de"): "not", ("alles", "andere", "als"): "not", ("lejos", "de"): "not",
}
FORM_STARTS = frozenset(f[0] for f in FORMS)

TOKEN = regex.compile(r"(?<=n)['’]t(?!\p{L})|\p{L}+|[.!?;:\n]")
OTHER, INSULT, THREATENS, TARGETS, NEGATES, REPORTS, ENDS, OPENS = range(8)
REACH = 3

#: For texts of one byte a character: letters stay, clause ends become full stops, all else a space.
_PLAIN = bytes(b if chr(b).isalpha() else 46 if chr(b) in ".!?;:\n" else b if b == 1 else 32 for b in range(256))


def plain_tokens(low: str) -> list[str]:
    """Tokens of a text in lower case."""
    return [NOT if t[0] in "'’" else "." if t in "!?;:\n" else t for t in TOKEN.findall(low)]


def tokens_of(text: str | None) -> list[str]:
    """Words in lower case, clause ends as one token each."""
    low = (text or "").lower()
    try:
        raw = low.encode("latin-1")
    except UnicodeEncodeError:
        return plain_tokens(low)
    if b"n't" in raw:
        raw = re.sub(rb"(?<=n)'t(?![a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff])", b" \x01t ", raw.replace(b"\x01", b" "))
    else:
        raw = raw.replace(b"\x01", b" ")
    out = raw.translate(_PLAIN).replace(b".", b" . ").decode("latin-1").split()
    return [NOT if t == "\x01t" else t for t in out] if b"\x01" in raw else out


def follow(left: int, cls: int, what: int) -> int:
    """A transducer that remembers a class for REACH tokens of the clause."""
    return 0 if cls == ENDS else REACH if cls == what else max(0, left - 1)


def within(on: int, cls: int, what: int) -> int:
    """A transducer that remembers a class until the clause ends."""
    return 0 if cls == ENDS else 1 if cls == what else on


def composed() -> tuple[list[tuple[int, ...]], list[tuple[float, ...]]]:
    """By state: next state and factor by class, of negation, target and threat reach and report together. State 0 is the start."""
    states = list(itertools.product(range(REACH + 1), range(REACH + 1), range(REACH + 1), range(2)))
    number = {s: i for i, s in enumerate(states)}
    steps, factors = [], []
    for n, t, h, r in states:
        weaker = (0.4 if n else 1.0) * (0.6 if r else 1.0)
        own = {INSULT: 1.3 if t or h else 1.0, TARGETS: 1.0 if h else 0.0, THREATENS: 1.0 if t else 0.0}
        steps.append(tuple(number[follow(n, c, NEGATES), follow(t, c, TARGETS), follow(h, c, THREATENS), within(r, c, REPORTS)] for c in range(OPENS)))
        factors.append(tuple(weaker * own.get(c, 0.0) for c in range(OPENS)))
    return steps, factors


STEPS, FACTORS = composed()
THREAT_WEIGHT = 2.0


class Classes(dict):
    """Class by word, remembered up to a bound."""

    def __init__(self, lexicon: dict[str, float]) -> None:
        super().__init__()
        self.lexicon = lexicon
        #: What a word must begin with to be an insult.
        self.starts = frozenset(k[: BEGINNINGS[0]] for k in lexicon)

    def weight(self, w: str) -> float:
        return max((self.lexicon.get(k, 0.0) for k in stems(w)), default=0.0) if w[: BEGINNINGS[0]] in self.starts else 0.0

    def __missing__(self, w: str) -> int:
        if w == ".":
            out = ENDS
        elif self.weight(w):
            out = INSULT
        elif w in THREAT:
            out = THREATENS
        elif w in TARGET:
            out = TARGETS
        elif w in NEGATION:
            out = NEGATES
        elif w in REPORT:
            out = REPORTS
        else:
            out = OPENS if w in FORM_STARTS else OTHER
        if len(self) > 300_000:
            self.clear()
        self[w] = out
        return out


def stems(word: str) -> list[str]:
    """The word itself, and its beginnings with a mark."""
    return [word, *(word[:k] + "*" for k in BEGINNINGS if len(word) >= k)]


def clause_score(tokens: list[str], codes: bytes, classes: Classes) -> float:
    """The composed transducer over one clause."""
    state, score, skip = 0, 0.0, 0
    for i, c in enumerate(codes):
        if skip:
            skip -= 1
            continue
        if c == OPENS:
            c = OTHER
            for f, as_word in FORMS.items():
                if tuple(tokens[i : i + len(f)]) == f:
                    c, skip = (REPORTS if as_word in REPORT else NEGATES), len(f) - 1
                    break
        factor = FACTORS[state][c]
        if factor:
            score += factor * (classes.weight(tokens[i]) if c == INSULT else THREAT_WEIGHT)
        state = STEPS[state][c]
    return score


def features(text: str | None, classes: Classes) -> list[float]:
    """Features of a text from its scored clauses."""
    tokens = tokens_of(text)
    codes = bytes(map(classes.__getitem__, tokens))
    cls = np.frombuffer(codes, np.uint8)
    at = np.flatnonzero((cls == INSULT) | (cls == THREATENS))
    clauses: list[float] = []
    kinds = {tokens[i] for i in at.tolist()}
    if len(at):
        ends = np.concatenate([[-1], np.flatnonzero(cls == ENDS), [len(cls)]])
        for k in np.unique(np.searchsorted(ends, at)).tolist():
            lo, hi = int(ends[k - 1]) + 1, int(ends[k])
            score = clause_score(tokens[lo:hi], codes[lo:hi], classes)
            if score > 0:
                clauses.append(score)
    n, total = max(1, len(tokens)), sum(clauses)
    return [math.log1p(total), max(clauses, default=0.0), math.log1p(len(clauses)), math.log1p(len(kinds)), math.log1p(1000 * total / n), math.log(n) * (total > 0), math.log1p(1000 * len(kinds) / n)]


N_FEATURES = 7


@dataclass(frozen=True)
class Model:
    lexicon: dict[str, float] = field(default_factory=dict)
    weights: tuple[float, ...] = (0.0,) * N_FEATURES
    bias: float = -20.0

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(x @ np.array(self.weights) + self.bias, -30, 30)))


_CLASSES: dict[int, Classes] = {}


def classes_of(lexicon: dict[str, float]) -> Classes:
    """One for each worker process and lexicon."""
    mark = zlib.crc32(repr(sorted(lexicon.items())).encode())
    if mark not in _CLASSES:
        _CLASSES.clear()
        _CLASSES[mark] = Classes(lexicon)
    return _CLASSES[mark]


def held_out(df: DataFrame):  # noqa: ANN201
    return F.coalesce(id_crc(df["doc_id"], 5) == 0, F.lit(False))


def sampled(docs: DataFrame, marks: DataFrame) -> DataFrame:
    """doc_id, toxic, half, text of the training sample; half 0 teaches insults, half 1 the regression."""
    train = no_clash(marks, "doc_id", "toxic").where(~held_out(marks) & F.col("toxic").isin(0, 1)).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    ids = train.orderBy(F.xxhash64("doc_id"), "doc_id").limit(FIT_ROWS).withColumn("half", (F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(5)) >= 3).cast("int"))
    return stored(no_clash(docs, "doc_id", "text").join(F.broadcast(ids), "doc_id").select("doc_id", "toxic", "half", "text"))


def insults(sample: DataFrame) -> dict[str, float]:
    """Stems with their weight: the log of how much likelier they are in toxic documents, at most LEXICON."""

    def work(toxic: list, texts: list) -> dict:
        sets = [{w for w in tokens_of(t) if len(w) > 1} for t in texts]
        signs = [min((zlib.crc32(w.encode()) for w in s), default=0) for s in sets]
        return {"toxic": toxic, "sign": signs, "stems": [list({k for w in s for k in stems(w)}) for s in sets]}

    rows = by_batch(sample.where("half = 0"), ["toxic", "text"], work, "toxic int, sign long, stems array<string>", 500_000)
    each = rows.select("toxic", "sign", F.explode("stems").alias("stem"))
    totals = dict(rows.groupBy("toxic").agg(F.count_distinct("sign")).collect())
    bad, good = totals.get(1, 0), totals.get(0, 0)
    if not bad or not good:
        return {}
    counts = each.distinct().groupBy("stem").agg(F.sum("toxic").alias("b"), F.sum(1 - F.col("toxic")).alias("g"))
    weight = F.log((F.col("b") + 0.5) / (bad + 1)) - F.log((F.col("g") + 0.5) / (good + 1))
    kept = counts.where(F.col("b") >= MIN_GROUPS).withColumn("weight", F.round(weight, 6)).where(F.col("weight") >= math.log(MIN_LIFT))
    # By what is gained: a common stem with a fair lift before a rare one with a high lift.
    top = kept.orderBy((F.col("weight") * F.col("b")).desc(), "stem").limit(LEXICON).collect()
    return {r.stem: r.weight for r in top}


def regression(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, float]:
    """Logistic regression with a small ridge, by Newton steps."""
    a = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(a.shape[1])
    ridge = np.diag([1e-1] * x.shape[1] + [1e-3])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve(a.T @ (a * (p * (1 - p))[:, None]) + ridge, a.T @ (y - p) - ridge @ w)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return w[:-1], float(w[-1])


def learn(docs: DataFrame, marks: DataFrame) -> Model:
    sample = sampled(docs, marks)
    lexicon = insults(sample)

    def work(toxic: list, texts: list) -> dict:
        classes = classes_of(lexicon)
        return {"toxic": toxic, "x": [features(t, classes) for t in texts]}

    # FIT_ROWS bounds what comes here; a fixed order, as sums of floats depend on it.
    rows = sorted(by_batch(sample.where("half = 1"), ["toxic", "text"], work, "toxic int, x array<double>").collect(), key=lambda r: (r.x, r.toxic))
    x, y = np.array([r.x for r in rows]).reshape(-1, N_FEATURES), np.array([r.toxic for r in rows], float)
    if not lexicon or len(set(y.tolist())) < 2:
        share = float(y.mean()) if len(y) else 0.0
        return Model(lexicon, bias=math.log(max(share, 1e-9) / max(1 - share, 1e-9)))
    weights, bias = regression(x, y)
    return Model(lexicon, tuple(weights.tolist()), bias)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score for each row."""

    def work(ids: list, texts: list) -> dict:
        classes = classes_of(model.lexicon)
        x = np.array([features(t, classes) for t in texts]).reshape(-1, N_FEATURES)
        return {"doc_id": ids, "score": model.score(x)}

    return by_batch(no_clash(docs, "doc_id", "text"), ["doc_id", "text"], work, "doc_id long, score double")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    out = score(docs, learn(docs, labels(spark, sf_dir)))
    return out.select("doc_id", held_out(out).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
