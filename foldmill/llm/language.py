"""Language of a text by cross-parsing entropy.

For each language some labelled text is held in a suffix automaton, which follows any substring of that text letter by letter. A text is parsed with it from
the left: each phrase is the longest match from where the last one ended (at least one letter). A text parses into few phrases with its own language. Counts are
made comparable by the logarithm of the labelled text's length, as the entropy estimate of cross-parsing has it (phrases x log n / letters); the language
that needs the fewest wins, the first one in code point order on ties. The score is the runner-up's share of both entropies: 1/2 for a tie, towards 1 the
clearer the choice, 1 if there is one language only.

Letters are compared in lower case, everything else ASCII counts as a space, and runs of spaces as one. Texts are read as UTF-8 bytes in blocks of ``BLOCK``; a phrase ends
with its block. The blocks of many texts run through an automaton side by side, so a step of all of them is one array operation. An automaton's edges lie in one table in
which the rows of its states are shifted into each other's gaps.

Learning reads a bounded sample: ``DOCS`` documents of each language, the first in the order of a hash of doc_id, ``PIECE`` characters of each and ``SAMPLE`` bytes in all.
Rows without lang, doc_id or text and held-out rows are not learned from; a doc_id that repeats counts once. Every text is predicted whole.

A null text and one without a letter is ``und`` with score 0, and so is every text if nothing could be learned. A null doc_id is not held out. Ties and repeated rows get
equal predictions. An empty table gives no rows; columns other than doc_id, text and lang are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from foldmill.llm.common import ready, slices
from foldmill.llm.quality import held_out

UNKNOWN = "und"
DOCS, PIECE, SAMPLE = 64, 2_000, 100_000
BLOCK, BYTES_AT_ONCE = 1_024, 16 << 20
#: ASCII that is no letter, as spaces.
BLANKED = bytes(c if c >= 128 or chr(c).isalpha() else 32 for c in range(256))
#: Stands between the documents of a sample; no text holds it after :func:`normal`.
BORDER = b"\n"


def normal(text: str) -> bytes:
    """Letters in lower case as UTF-8, single spaces between words."""
    return b" ".join(text.lower().encode("utf-8", "replace").translate(BLANKED).split())


def has_letter(text: str, found: bytes) -> bool:
    """Whether a text has a letter; ``found`` is its normal form, where any ASCII byte but the space is one."""
    return any(c < 128 and c != 32 for c in found[:64]) or any(map(str.isalpha, text))


def suffix_automaton(data: bytes) -> list[dict[int, int]]:
    """Edges of the states of the smallest automaton of all substrings; 0 is the start."""
    edges, link, length, last = [{}], [-1], [0], 0
    for c in data:
        new = len(edges)
        edges.append({})
        link.append(0)
        length.append(length[last] + 1)
        at = last
        while at >= 0 and c not in edges[at]:
            edges[at][c] = new
            at = link[at]
        if at >= 0:
            to = edges[at][c]
            if length[to] == length[at] + 1:
                link[new] = to
            else:
                twin = len(edges)
                edges.append(dict(edges[to]))
                link.append(link[to])
                length.append(length[at] + 1)
                while at >= 0 and edges[at].get(c) == to:
                    edges[at][c] = twin
                    at = link[at]
                link[to] = link[new] = twin
        last = new
    return edges


class Language:
    """The automaton of one language as arrays: the edge of state s by byte c is at ``base[s] + c``, as (s, next state) if there is one."""

    def __init__(self, name: str, sample: bytes):
        edges = suffix_automaton(sample)
        self.name, self.cost = name, float(np.log2(max(len(sample), 2)))
        many = sorted((s for s, row in enumerate(edges) if len(row) > 1), key=lambda s: (-len(edges[s]), s))
        one = [s for s, row in enumerate(edges) if len(row) == 1]
        room = sum(map(len, edges)) + 512
        self.base = np.zeros(len(edges), np.int32)
        used, place = bytearray(4 * room), 256
        for s in many:
            row, b = list(edges[s]), place
            while any(used[b + c] for c in row):
                b += 1
                if b + 512 > len(used):
                    used.extend(bytes(len(used)))
            for c in row:
                used[b + c] = 1
            self.base[s], place = b, max(place, b - 2)  # gaps left behind are for the states with one edge
        free = np.flatnonzero(np.frombuffer(used, np.uint8)[256:] == 0)[: len(one)] + 256
        if len(free) < len(one):
            free = np.concatenate([free, len(used) + np.arange(len(one) - len(free))])
        if one:
            self.base[one] = free - np.array([next(iter(edges[s])) for s in one])
        size = int(max(self.base.max(initial=0) + 256, 256)) + 1
        self.edges = np.full(size, -1, np.int64)
        for s, row in enumerate(edges):
            for c, to in row.items():
                self.edges[self.base[s] + c] = s << 32 | to
        self.first = np.zeros(256, np.int32)
        for c, to in edges[0].items():
            self.first[c] = to

    def phrases(self, steps: np.ndarray, live: np.ndarray) -> np.ndarray:
        """Phrases of each block; ``steps[t]`` holds the byte t of all blocks, of which the first ``live[t]`` are that long."""
        state, count = np.zeros(steps.shape[1], np.int32), np.ones(steps.shape[1], np.int32)
        for t in range(len(steps)):
            n = live[t]
            s, c = state[:n], steps[t, :n]
            edge = self.edges[self.base[s] + c]
            met = (edge >> 32) == s
            count[:n] += ~met
            state[:n] = np.where(met, edge & 0xFFFFFFFF, self.first[c])
        return count


def entropies(texts: list[bytes], languages: list[Language], block: int = BLOCK) -> np.ndarray:
    """phrases x log n / letters of each text (normal form) in each language; zero for empty texts."""
    out = np.zeros((len(texts), len(languages)))
    for first, last in slices([len(t) for t in texts], BYTES_AT_ONCE):
        for a in range(first, last):  # a text above the bound stands alone and is read piece by piece
            if len(texts[a]) > BYTES_AT_ONCE:
                pieces = [texts[a][i : i + BYTES_AT_ONCE] for i in range(0, len(texts[a]), BYTES_AT_ONCE)]
                counts = sum(_counts([p], languages, block) for p in pieces)
                break
        else:
            counts = _counts(texts[first:last], languages, block)
        letters = np.array([max(len(t), 1) for t in texts[first:last]])
        out[first:last] = counts * np.array([x.cost for x in languages]) / letters[:, None]
    return out


def _counts(texts: list[bytes], languages: list[Language], block: int) -> np.ndarray:
    spans = [(n, i) for n, t in enumerate(texts) for i in range(0, len(t), block)]
    if not spans:
        return np.zeros((len(texts), len(languages)))
    lengths = np.array([min(block, len(texts[n]) - i) for n, i in spans])
    order = np.argsort(-lengths, kind="stable")
    steps = np.zeros((int(lengths.max()), len(spans)), np.uint8)
    for column, k in enumerate(order.tolist()):
        n, i = spans[k]
        steps[: lengths[k], column] = np.frombuffer(texts[n], np.uint8, lengths[k], i)
    live = np.searchsorted(-lengths[order], -np.arange(len(steps)), side="left")
    owner = np.array([n for n, _ in spans])[order]
    return np.stack([np.bincount(owner, x.phrases(steps, live), len(texts)) for x in languages], axis=1)


def training_texts(docs: DataFrame, most: int = DOCS) -> list[tuple[str, bytes]]:
    """Each language in code point order with its labelled text, in the sample's bounds."""
    known = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    known = known.where(F.col("doc_id").isNotNull() & F.col("text").isNotNull() & F.col("lang").isNotNull() & ~held_out(F.col("doc_id")))
    sizes = known.groupBy("lang").agg(F.approx_count_distinct("doc_id").alias("n")).collect()  # a row a language
    if not sizes:
        return []
    # about four times as many as needed pass, whatever the size of the table; the window then takes the first ones
    bounds = docs.sparkSession.createDataFrame([(r["lang"], min(1.0, 4 * most / r["n"])) for r in sizes], "lang string, share double")
    place = F.pmod(F.xxhash64("doc_id"), F.lit(2**31))
    few = known.join(F.broadcast(bounds), "lang").where(place <= F.col("share") * 2**31)
    few = few.groupBy("lang", "doc_id").agg(F.min(F.substring("text", 1, PIECE)).alias("text")).withColumn("place", place)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("place", "doc_id"))
    taken = few.withColumn("rank", rank).where(F.col("rank") <= most).select("lang", "rank", "text").collect()
    texts: dict[str, list[bytes]] = {}
    for r in sorted(taken, key=lambda r: (r["lang"], r["rank"])):
        texts.setdefault(r["lang"], []).append(normal(r["text"]))
    return [(name, BORDER.join(found)[:SAMPLE]) for name, found in texts.items()]


def predicted(docs: DataFrame, languages: list[Language]) -> DataFrame:
    """doc_id, lang_pred, score of every row."""
    names = [x.name for x in languages]

    def run(batches):
        for batch in batches:
            texts = [normal(x) if x is not None else b"" for x in batch.column(1).to_pylist()]
            lettered = np.array([bool(t) and has_letter(batch.column(1)[i].as_py(), t) for i, t in enumerate(texts)], bool)
            best, score = np.zeros(len(texts), np.int64), np.zeros(len(texts))
            if names and len(texts):
                found = entropies(texts, languages)
                best = found.argmin(axis=1)
                least = found[np.arange(len(texts)), best]
                score = np.ones(len(texts))
                if len(names) > 1:
                    second = np.partition(found, 1, axis=1)[:, 1]
                    score = second / np.where(least + second > 0, least + second, 1)
            chosen = [names[b] if ok and names else UNKNOWN for b, ok in zip(best.tolist(), lettered.tolist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(chosen, pa.string()), pa.array(np.where(lettered, score, 0.0))], names=["doc_id", "lang_pred", "score"])

    ready(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, lang_pred string, score double")


def report(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every document."""
    languages = [Language(name, sample) for name, sample in training_texts(docs)]
    return predicted(docs, languages).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
