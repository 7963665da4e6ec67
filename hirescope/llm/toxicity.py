"""Toxicity scoring: a learned lexicon, matched through Levenshtein automata.

The lexicon (whole words, and stems that take any ending) is learned from
labelled documents.  It is kept as a trie; the Levenshtein automaton of a
token is intersected with the trie while the token is read, so a misspelled
term is found without trying the entries one by one.  The states of that
product are determinised lazily and shared by all tokens of a task.

Every match is weighed by its context window: a match inside quotation marks
or next to a reporting word counts little, one next to a word of address
counts more.  A logistic model over a document's evidence gives the score.
"""

from __future__ import annotations

import hashlib
import heapq
import math
import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirescope.llm.common import map_texts, materialise, text_batches

_TOKEN = re.compile(r"\w+")
_QUOTED = re.compile(r"\"[^\"\n]{1,400}\"|“[^”\n]{1,400}”|«[^»\n]{1,400}»|„[^“\n]{1,400}“")
#: Words that introduce somebody else's words, and words that address a reader.
REPORTING = frozenset("said says wrote writes called calls quote quoted quotes term word slur insult "
                      "sagte sagt schrieb nannte zitat dit écrit appelé citation dijo escribió llamó cita".split())
ADDRESS = frozenset("you your youre u ur du dich dein ihr euch tu toi vous ton tú te usted ustedes".split())

STEM = range(4, 9)


def edits_allowed(term: str, stem: bool) -> int:
    """Misspellings tolerated, by length; short entries must match exactly."""
    n = len(term)
    if stem:
        return int(n >= 7)
    return 0 if n < 5 else 1 if n < 9 else 2


class Lexicon:
    """Trie of the entries, and the automaton product over it."""

    def __init__(self, entries: list[tuple[str, bool]], most_states: int = 20_000):
        self.entries, self.most_states = entries, most_states
        self.children: list[dict[str, int]] = [{}]
        self.word: list[int] = [-1]
        self.stem: list[int] = [-1]
        self.room = [0]  # most edits that an entry below the node allows
        for number, (term, is_stem) in enumerate(entries):
            allowed, node = edits_allowed(term, is_stem), 0
            self.room[0] = max(self.room[0], allowed)
            for ch in term:
                if ch not in self.children[node]:
                    self.children[node][ch] = len(self.children)
                    for col, value in ((self.children, {}), (self.word, -1), (self.stem, -1), (self.room, 0)):
                        col.append(value)
                node = self.children[node][ch]
                self.room[node] = max(self.room[node], allowed)
            (self.stem if is_stem else self.word)[node] = number
        self.forget()

    def forget(self) -> None:
        """Drop the states determinised so far."""
        self._ids: dict[frozenset, int] = {}
        self._sets: list[frozenset] = []
        self.next: list[dict[str, int]] = []
        self.at_end: list[tuple[int, int] | None] = []
        self.passing: list[tuple[int, int] | None] = []
        self._state(frozenset(self._close({(0, 0, "")})))

    def _close(self, items: set) -> set:
        """Add what dropping an entry's next letters reaches."""
        out, todo = set(), list(items)
        while todo:
            node, err, wait = item = todo.pop()
            if item in out or err > self.room[node]:
                continue
            out.add(item)
            if not wait:
                todo.extend((child, err + 1, "") for child in self.children[node].values())
        return out

    def _best(self, items, mark: list[int], stem: bool) -> tuple[int, int] | None:
        found = [(err, mark[node]) for node, err, wait in items if not wait and mark[node] >= 0
                 and err <= edits_allowed(self.entries[mark[node]][0], stem)]
        return min(found)[::-1] if found else None

    def _state(self, items: frozenset) -> int:
        if items not in self._ids:
            self._ids[items] = len(self._sets)
            self._sets.append(items)
            self.next.append({})
            self.at_end.append(self._best(items, self.word, False))
            self.passing.append(self._best(items, self.stem, True))
        return self._ids[items]

    def _step(self, state: int, ch: str) -> int:
        out = set()
        for node, err, wait in self._sets[state]:
            if wait:
                if wait == ch:
                    out.add((node, err, ""))
                continue
            kids = self.children[node]
            out.add((node, err + 1, ""))  # a letter too many
            for label, child in kids.items():
                out.add((child, err + (label != ch), ""))  # the letter, or another in its place
                if label != ch and ch in self.children[child]:
                    out.add((self.children[child][ch], err + 1, label))  # two letters swapped
        items = frozenset(self._close({x for x in out if x[1] <= self.room[x[0]]}))
        target = self._state(items) if items else -1
        self.next[state][ch] = target
        return target

    def match(self, token: str) -> tuple[int, int] | None:
        """(entry, edits) of the closest entry, or None."""
        if len(self._sets) > self.most_states:
            self.forget()
        state, best = 0, None
        for ch in token:
            target = self.next[state].get(ch)
            if target is None:
                target = self._step(state, ch)
            if target < 0:
                return best
            state = target
            hit = self.passing[state]
            if hit and (best is None or hit[1] < best[1]):
                best = hit
        hit = self.at_end[state]
        return hit if hit and (best is None or hit[1] <= best[1]) else best


class _Memo(dict):
    """Token -> match, filled on demand, of bounded size."""

    def __init__(self, lexicon: Lexicon, most: int = 400_000):
        self.lexicon, self.most = lexicon, most

    def __missing__(self, token: str):
        if len(self) >= self.most:
            self.clear()
        self[token] = out = self.lexicon.match(token)
        return out


def matches(text: str, memo: _Memo, window: int = 8) -> tuple[int, list[tuple[int, int, int, int, float]]]:
    """Token count, and (entry, edits, start, end, context factor) per match."""
    lower = text.lower()
    if not any(map(memo.__getitem__, set(_TOKEN.findall(lower)))):
        return len(_TOKEN.findall(lower)), []
    if len(lower) != len(text):  # a letter whose lower case is longer: offsets follow the lower-cased text
        text = lower
    found = list(_TOKEN.finditer(lower))
    words = [m.group() for m in found]
    quotes = [m.span() for m in _QUOTED.finditer(text)]
    out = []
    for i, w in enumerate(words):
        hit = memo[w]
        if hit:
            near = words[max(0, i - window):i + window + 1]
            start, end = found[i].span()
            if any(a < start and end < b for a, b in quotes) or not REPORTING.isdisjoint(near):
                factor = 0.25
            else:
                factor = 1.0 if ADDRESS.isdisjoint(near) else 1.15
            out.append((*hit, start, end, factor))
    return len(words), out


def evidence(hits) -> list[tuple[int, int, float, float]]:
    """(entry, edits, largest factor, sum of factors) of all matches."""
    out: dict[tuple[int, int], tuple[float, float]] = {}
    for entry, edits, _, _, factor in hits:
        most, total = out.get((entry, edits), (0.0, 0.0))
        out[entry, edits] = max(most, factor), total + factor
    return [(*key, *value) for key, value in sorted(out.items())]


@dataclass(frozen=True)
class Model:
    entries: list[tuple[str, bool]]
    exact: list[float]
    fuzzy: list[float]
    coef: list[float]

    def features(self, n_words: int, found) -> list[float]:
        """Features of a document's ``evidence``."""
        best: dict[int, float] = defaultdict(float)
        for entry, edits, factor, _ in found:
            best[entry] = max(best[entry], (self.fuzzy if edits else self.exact)[entry] * factor)
        total = sum(best.values())
        strong = sum(factors for entry, edits, _, factors in found if (self.fuzzy if edits else self.exact)[entry] > 0)
        return [1.0, math.log1p(total), max(best.values(), default=0.0), math.log1p(100 * strong / max(1, n_words))]

    def score(self, n_words: int, found) -> float:
        z = sum(a * b for a, b in zip(self.coef, self.features(n_words, found)))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def _gain(t: float, c: float, total: float, clean: float) -> float:
    """Log-likelihood ratio of a term's document counts under the two classes."""
    p = (t + c) / (total + clean)
    out = 0.0
    for k, n in ((t, total), (c, clean)):
        for x, q in ((k, p), (n - k, 1 - p)):
            if x > 0 and n > 0 and q > 0:
                out += 2 * x * math.log(x / n / q)
    return out


def _term_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for texts, toxic in text_batches(batches, (0, 1), 0):
        counts: tuple[Counter, Counter] = (Counter(), Counter())
        for text, y in zip(texts, toxic):
            words = set(_TOKEN.findall((text or "").lower()))
            counts[y].update((w, False) for w in words)
            counts[y].update({(w[:n], True) for w in words for n in STEM if len(w) > n})
        keys = list(counts[0].keys() | counts[1].keys())
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.bool_()),
             pa.array([counts[1][k] for k in keys], pa.int64()), pa.array([counts[0][k] for k in keys], pa.int64())],
            names=["term", "stem", "t", "c"])


def choose_entries(rows, n_toxic: int, n_clean: int, min_gain: float, min_lift: float = 4.0):
    """Lexicon entries with their log-odds weights from (term, stem, t, c) rows."""
    good = {}
    for term, stem, t, c in rows:
        weight = math.log((t + 0.5) / (n_toxic + 1)) - math.log((c + 0.5) / (n_clean + 1))
        if weight > math.log(min_lift) and _gain(t, c, n_toxic, n_clean) >= min_gain:
            good[(term, stem)] = (t, weight)
    top_word: dict[str, int] = defaultdict(int)
    for (term, stem), (t, _) in good.items():
        if not stem:
            for n in STEM:
                top_word[term[:n]] = max(top_word[term[:n]], t)
    longer = defaultdict(int)
    for (term, stem), (t, _) in good.items():
        if stem:
            longer[term[:-1]] = max(longer[term[:-1]], t)
    out: dict[tuple[str, bool], float] = {}
    for (term, stem), (t, weight) in sorted(good.items(), key=lambda x: (len(x[0][0]), not x[0][1], x[0][0])):
        # A stem must stand for several words, and not for one longer stem.
        if stem and (t < 1.5 * top_word[term] or longer[term] >= 0.9 * t):
            continue
        if any(out.get((term[:n], True), -1.0) >= weight - 0.7 for n in STEM if n < len(term) + (not stem)):
            continue
        out[(term, stem)] = weight
    return out


def sketch(words: set[str], size: int = 64) -> list[int]:
    """The least hashes of a document's words."""
    return heapq.nsmallest(size, {zlib.crc32(w.encode()) for w in words})


def apart(sketches: list[list[int]], alike: float = 0.5) -> list[int]:
    """Group numbers of documents: those whose sketches agree in half of their
    hashes are copies of each other, and so are copies of copies.  Groups are
    of any size; a document is compared with all that are in no group yet."""
    where: dict[int, list[int]] = defaultdict(list)
    for d, found in enumerate(sketches):
        for e in found:
            where[e].append(d)
    holding = {e: np.array(held) for e, held in where.items()}
    size = np.array([len(x) for x in sketches], np.int64)
    group = np.full(len(sketches), -1)
    for first in range(len(sketches)):
        if group[first] >= 0:
            continue
        group[first], todo = first, [first]
        while todo:
            d = todo.pop()
            for e in sketches[d]:
                holding[e] = holding[e][group[holding[e]] < 0]
            others, shared = np.unique(np.concatenate([np.zeros(0, np.int64), *[holding[e] for e in sketches[d]]]),
                                       return_counts=True)
            copies = others[shared >= alike * (size[others] + size[d] - shared)]
            group[copies] = first
            todo.extend(copies.tolist())
    return group.tolist()


def _fit(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 30) -> np.ndarray:
    """Ridge logistic regression by Newton steps; the constant is not shrunk much."""
    penalty = np.full(x.shape[1], ridge)
    penalty[0] = 0.01
    b = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty), x.T @ (y - p) - penalty * b)
        b = b + step
        if np.abs(step).max() < 1e-8:
            break
    return b


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic", max_labelled: int = 20_000, max_entries: int = 4096, min_gain: float = 20.0) -> Model:
    """Lexicon and weights from labelled documents (label 1: toxic).

    At most ``max_labelled`` labelled documents are used, those of the least
    ``xxhash64(id)``; only the lexicon (at most ``max_entries`` entries) and a
    few numbers per labelled document come to the driver.  A document with
    several labels counts as toxic if any says so; rows with a null id or
    label are ignored.  With no labels of one kind the lexicon is empty and
    every document gets the share of label 1 (0 without labels) as its score.
    """
    given = (labels.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("y"))
             .dropna().groupBy("id").agg(F.max("y").alias("y"))
             .orderBy(F.xxhash64("id"), "id").limit(max_labelled))
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    train = materialise(texts.join(F.broadcast(given), "id")
                        .select("text", F.when(F.col("y") > 0, 1).otherwise(0).alias("y")))
    n = {r["y"]: r["count"] for r in train.groupBy("y").count().collect()}
    n_toxic, n_clean = n.get(1, 0), n.get(0, 0)
    if not n_toxic or not n_clean:
        share = n_toxic / max(1, n_toxic + n_clean)
        return Model([], [], [], [math.log((share + 1e-9) / (1 - share + 1e-9)), 0.0, 0.0, 0.0])
    rows = (train.mapInArrow(_term_counts, "term string, stem boolean, t long, c long")
            .groupBy("term", "stem").agg(F.sum("t").alias("t"), F.sum("c").alias("c"))
            .where(F.col("t") >= 3).where((F.col("t") + 0.5) * (n_clean + 1) > 4 * (F.col("c") + 0.5) * (n_toxic + 1))
            .orderBy(F.desc(F.col("t") - F.col("c") * (n_toxic / n_clean)), "term", "stem")
            .limit(10 * max_entries).collect())
    chosen = choose_entries([tuple(r) for r in rows], n_toxic, n_clean, min_gain)
    order = sorted(chosen, key=lambda k: (-chosen[k], k))[:max_entries]

    def holding(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = {e: i for i, e in enumerate(order)}
        for (part,) in text_batches(batches, (0,), 0):
            found, sketches, digests = [], [], []
            for text in part:
                words = set(_TOKEN.findall((text or "").lower()))
                keys = {(w, False) for w in words} | {(w[:n], True) for w in words for n in STEM if len(w) > n}
                found.append([at[k] for k in keys if k in at])
                sketches.append(sketch(words))
                digests.append(hashlib.md5(" ".join(sorted(words)).encode(), usedforsecurity=False).digest())
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.int32())),
                                              pa.array(sketches, pa.list_(pa.int64())),
                                              pa.array(digests, pa.binary())], names=["e", "s", "d"])

    # One row per set of words: exact copies hold the same entries.
    toxic = (train.where("y = 1").select("text").mapInArrow(holding, "e array<int>, s array<long>, d binary")
             .groupBy("d").agg(F.first("e").alias("e"), F.first("s").alias("s")).orderBy("d").collect())
    # Words that only recur because a toxic document has copies fall out.
    holders: dict[int, set[int]] = defaultdict(set)
    for group, r in zip(apart([r["s"] for r in toxic]), toxic):
        for e in r["e"]:
            holders[e].add(group)
    clean_with = {(r["term"], r["stem"]): r["c"] for r in rows}
    entries = [e for i, e in enumerate(order)
               if _gain(len(holders[i]), clean_with[e], n_toxic, n_clean) >= min_gain]
    exact = [chosen[e] for e in entries]

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = _Memo(Lexicon(entries))
        kind = pa.list_(pa.struct([("entry", pa.int32()), ("edits", pa.int32()), ("factor", pa.float64()),
                                   ("factors", pa.float64())]))
        for part, ys in text_batches(batches, (0, 1), 0):
            got = [matches(t or "", memo) for t in part]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ys, pa.int32()), pa.array([g[0] for g in got], pa.int64()),
                 pa.array([[{"entry": e, "edits": d, "factor": f, "factors": n} for e, d, f, n in evidence(g[1])]
                           for g in got], kind),
                 pa.array([len(g[1]) for g in got], pa.int64())], names=["y", "n", "hits", "k"])

    seen = train.mapInArrow(found, "y int, n long, hits array<struct<entry:int,edits:int,factor:double,factors:double>>, k long").collect()
    near = [[2.5, 0.5] for _ in entries]  # a misspelling is taken for the term until documents say otherwise
    for r in seen:
        for h in {h["entry"] for h in r["hits"] if h["edits"]}:
            near[h][0 if r["y"] else 1] += 1
    fuzzy = [max(0.0, min(0.8 * w, math.log(t / (n_toxic + 1)) - math.log(c / (n_clean + 1))))
             for w, (t, c) in zip(exact, near)]
    model = Model(entries, exact, fuzzy, [0.0] * 4)
    x = np.array([model.features(r["n"], [tuple(h) for h in r["hits"]])
                  for r in seen])
    coef = _fit(x, np.array([r["y"] for r in seen], float))
    return Model(entries, exact, fuzzy, coef.tolist())


_MATCH = "array<struct<term:string,start:long,end:long,edits:int,factor:double>>"


def score(docs: DataFrame, model: Model, text_col: str = "text", carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``score, matches, row`` per row; every whole text is read once.

    ``matches`` has the term, the code point range, the number of edits and
    the context factor of each match; ``row`` is a struct of the ``carry``
    columns.  Null and empty texts have no match and get the score of a
    document without any.  Repeated rows repeat.
    """
    def make():
        memo = _Memo(Lexicon(model.entries))
        kind = pa.list_(pa.struct([("term", pa.string()), ("start", pa.int64()), ("end", pa.int64()),
                                   ("edits", pa.int32()), ("factor", pa.float64())]))

        def work(texts):
            got = [matches(t or "", memo) for t in texts]
            scores = [model.score(n, evidence(hits)) for n, hits in got]
            found = [[{"term": model.entries[e][0], "start": s, "end": t, "edits": d, "factor": f}
                      for e, d, s, t, f in hits] for _, hits in got]
            return [pa.array(scores, pa.float64()), pa.array(found, kind)]
        return work

    return map_texts(docs, text_col, list(carry), f"score double, matches {_MATCH}", make)
