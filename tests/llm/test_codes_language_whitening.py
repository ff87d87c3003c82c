"""Vector codes, language and whitening against plain versions, and their edge cases."""

from __future__ import annotations

import hashlib
import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from foldmill.llm import gnat, language, whitening
from foldmill.llm.gnat import Gnat
from foldmill.llm.queries import ORACLES, QUERIES
from foldmill.llm.whitening import Spectrum, updated
from oracle import difference

VECTORS = "vec_id long, embedding array<float>, label int, score double, x string, n int"


def table(make, vectors, labels=None):
    labels = labels or [None] * len(vectors)
    return make([(i, v, y, 0.5, "x", 7) for (i, v), y in zip(vectors, labels)], VECTORS)


# --- codes ------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("seed,entries,width,reach", [(0, 64, 4, 40), (1, 64, 4, 3), (2, 200, 2, 2), (3, 64, 8, 2**26), (4, 3, 4, 10), (5, 100, 1, 1)])
def test_gnat_equals_all_entries(seed, entries, width, reach):
    """Also with many equal entries and ties, and at the largest whole numbers."""
    rng = np.random.default_rng(seed)
    book, queries = rng.integers(-reach, reach + 1, (entries, width)), rng.integers(-reach, reach + 1, (3_000, width))
    place, distance, _ = Gnat(book).nearest(queries)
    away = ((queries[:, None].astype(object) - book[None].astype(object)) ** 2).sum(axis=2)
    assert (distance == away.min(axis=1)).all()
    assert (place == [row.tolist().index(min(row)) for row in away]).all()


def test_gnat_leaves_subtrees_out():
    rng = np.random.default_rng(0)
    centres = rng.integers(-10_000, 10_000, (10, 4))
    book = (centres[:, None] + rng.integers(-20, 20, (10, 50, 4))).reshape(-1, 4)
    queries = book[rng.integers(0, len(book), 2_000)] + 3
    _, _, measured = Gnat(book).nearest(queries)
    assert measured < 0.25 * len(book) * len(queries)


def plain_codes(rows):
    """(vec_id, code, error, label_error) and the digest by plain loops."""
    kept = [(i, [math.floor(256 * float(np.float32(c))) for c in v], y) for i, v, y in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    part = len(kept[0][1]) // 16
    cut = lambda x, p: x[p * part : (p + 1) * part]
    far = lambda a, b: sum((s - t) ** 2 for s, t in zip(a, b))
    books = [[cut(x, p) for _, x, _ in sorted(kept)[:64]] for p in range(16)]
    assign = lambda: [[min(range(len(books[p])), key=lambda e: (far(cut(x, p), books[p][e]), e)) for p in range(16)] for _, x, _ in kept]
    for _ in range(2):
        codes = assign()
        for p in range(16):
            for e in range(len(books[p])):
                own = [cut(x, p) for (_, x, _), c in zip(kept, codes) if c[p] == e]
                if own:
                    books[p][e] = [sum(column) // len(own) for column in zip(*own)]
    codes = assign()
    errors = [sum(far(cut(x, p), books[p][c[p]]) for p in range(16)) for (_, x, _), c in zip(kept, codes)]
    sums = {}
    for (_, _, y), e in zip(kept, errors):
        sums[y] = sums.get(y, 0) + e
    digest = hashlib.sha256(",".join(str(c) for book in books for entry in book for c in entry).encode()).hexdigest()
    return sorted((i, "".join(f"{c:02x}" for c in code), e, sums[y], digest) for (i, _, y), code, e in zip(kept, codes, errors))


def test_codes_equal_plain_loops(spark, make):
    rng = np.random.default_rng(1)
    rows = [(int(i), (rng.integers(-3, 4, 32) / 64).tolist(), int(i) % 3 if i % 5 else None) for i in rng.permutation(150)]
    rows += [(400, None, 1), (401, [float("nan")] * 32, 1), (402, [float("inf")] + [0.0] * 31, 1), (403, [None] + [0.0] * 31, 1)]
    rows += [(7, rows[3][1], 2), (7, rows[3][1], 2), (500, [0.1] * 32, 0), (501, [-0.0] * 32, 0), (502, [1000.0] * 32, None)]
    df = table(make, [(i, v) for i, v, _ in rows], [y for *_, y in rows])
    want = plain_codes(rows)
    for pieces in (1, 7):
        got = sorted(tuple(r) for r in gnat.report(df.repartition(pieces)).select("vec_id", "code", "error", "label_error", "codebooks_sha256").collect())
        assert got == want


def test_codes_equal_sql(spark, sf_dir):
    assert difference(QUERIES["op11_vector_codes"](spark, sf_dir), ORACLES["op11_vector_codes"], sf_dir) is None


def test_codes_of_odd_tables(spark, make):
    assert gnat.report(table(make, [])).collect() == []
    assert gnat.report(table(make, [(1, None), (2, [float("nan")])])).collect() == []
    [one] = gnat.report(table(make, [(None, [0.5] * 16)])).collect()
    assert (one["vec_id"], one["code"], one["error"], one["label_error"]) == (None, "00" * 16, 0, 0)
    mixed = gnat.report(table(make, [(1, [1.0] * 20), (2, [1.0, 2.0]), (3, [])])).collect()
    assert sorted(r["vec_id"] for r in mixed) == [1, 2, 3] and all(len(r["code"]) == 32 and r["error"] == 0 for r in mixed)
    copies = gnat.report(table(make, [(i % 2, [0.25] * 16) for i in range(300)]))
    assert copies.count() == 300 and {r["code"] for r in copies.collect()} == {"00" * 16}


# --- language ---------------------------------------------------------------------------------------------


def plain_phrases(text: bytes, sample: bytes, block: int) -> int:
    count = 0
    for at in range(0, len(text), block):
        held, count = b"", count + 1
        for c in text[at : at + block]:
            c = bytes([c])
            if held + c in sample:
                held += c
            else:
                count, held = count + 1, c if c in sample else b""
    return count


def test_phrases_equal_plain_parsing():
    rng = np.random.default_rng(0)
    draw = lambda n, letters: bytes(rng.choice(list(letters), n).tolist())
    samples = [draw(400, b"ab c"), draw(300, b"abcde\n"), b"a", b"", "été ça".encode() * 3]
    texts = [b"", b"a", b"zzz", draw(1, b"ab"), draw(3_000, b"abc "), draw(700, b"abcdexyz"), "l'été à ça".encode(), draw(1_024, b"ab"), draw(1_025, b"ab")]
    languages = [language.Language(str(i), s) for i, s in enumerate(samples)]
    got = language.entropies(texts, languages)
    for n, text in enumerate(texts):
        for k, (sample, known) in enumerate(zip(samples, languages)):
            want = plain_phrases(text, sample, language.BLOCK) if text else 0
            assert got[n, k] == pytest.approx(want * known.cost / max(len(text), 1))


def test_very_long_texts_are_read_whole(monkeypatch):
    languages = [language.Language("x", b"ab ab ba"), language.Language("y", b"cd dc")]
    texts = [b"ab " * 700, b"cd" * 5_000 + b"ab", b"ba"]
    whole = language.entropies(texts, languages)
    monkeypatch.setattr(language, "BYTES_AT_ONCE", 2_048)
    assert language.entropies(texts, languages) == pytest.approx(whole)
    assert whole[1, 1] < whole[1, 0]


def test_automaton_knows_substrings_only():
    data = b"abcbcabbb"
    edges = language.suffix_automaton(data)

    def known(word):
        at = 0
        for c in word:
            if c not in edges[at]:
                return False
            at = edges[at][c]
        return True

    rng = np.random.default_rng(1)
    for _ in range(500):
        word = bytes(rng.choice(list(b"abc"), rng.integers(1, 6)).tolist())
        assert known(word) == (word in data)


def test_held_out_accuracy(spark):
    """On the test data's own texts, learned from others."""
    sf_dir = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang")
    rows = QUERIES["op12_language"](spark, sf_dir).join(docs, "doc_id").collect()
    held = [r for r in rows if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    assert len(rows) == docs.count() and len(held) > 150
    assert sum(r["lang"] == r["lang_pred"] for r in held) >= 0.98 * len(held)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_labels_of_held_out_rows_do_not_count(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang", "source")
    held = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    other = docs.withColumns({"lang": F.when(held, F.lit("xx")).otherwise(F.col("lang")), "source": F.lit(None)})
    assert sorted(language.report(docs).collect(), key=str) == sorted(language.report(other).collect(), key=str)


DOCS = "doc_id long, text string, lang string, score string, place int"


def test_odd_texts(spark, make):
    words = {"aa": "kolo molo tolo", "bb": "sine tine wine"}
    rows = [(i, words["aa" if i % 2 else "bb"], "aa" if i % 2 else "bb", "s", 1) for i in range(40)]
    rows += [(100, None, "aa", "s", 1), (101, "", None, "s", 1), (102, "12 !? 3\n", None, "s", 1), (103, "漢字", None, "s", 1), (104, "KOLO molo", None, "s", 1)]
    rows += [(None, "wine", None, "s", 1), (105, "wine", "bb", "s", 1), (105, "wine", "bb", "s", 1), (106, "§§ ¶", None, "s", 1), (107, "sine " * 30_000, None, "s", 1)]
    got = {r["doc_id"]: r for r in language.report(make(rows, DOCS)).collect()}
    assert language.report(make(rows, DOCS)).count() == len(rows)
    assert [got[i]["lang_pred"] for i in (100, 101, 102, 106)] == ["und"] * 4 and got[100]["score"] == 0.0
    assert got[103]["lang_pred"] in ("aa", "bb") and got[104]["lang_pred"] == "aa" and got[107]["lang_pred"] == "bb"
    assert got[None]["lang_pred"] == "bb" and got[None]["held_out"] is False


def test_nothing_to_learn_from(spark, make):
    assert language.report(make([], DOCS)).collect() == []
    [row] = language.report(make([(1, "text", None, "s", 1)], DOCS)).collect()
    assert (row["lang_pred"], row["score"]) == ("und", 0.0)
    [row] = language.report(make([(1, "text", "zz", "s", 1)], DOCS)).collect()
    assert (row["lang_pred"], row["score"]) == ("zz", 1.0)


def test_a_document_that_fills_a_third_of_the_table(spark, make):
    """It counts once in the sample."""
    rows = [(1, "kolo molo", "aa", "s", 1)] * 500 + [(i, "kolo tolo", "aa", "s", 1) for i in range(3, 20)] + [(i, "sine wine", "bb", "s", 1) for i in range(30, 50)]
    texts = dict(language.training_texts(make(rows, DOCS)))
    assert texts["aa"].count(b"kolo molo") == 1 and texts["bb"].count(b"sine wine") > 5


# --- whitening --------------------------------------------------------------------------------------------


@pytest.mark.parametrize("seed", range(6))
def test_rank_one_updates(seed):
    """Random terms, terms along an axis (deflated), repeated and zero ones, over equal eigenvalues at first."""
    rng = np.random.default_rng(seed)
    size = [1, 2, 5, 16, 33, 64][seed]
    d, vectors, whole = np.zeros(size), np.eye(size), np.zeros((size, size))
    for step in range(120):
        v = rng.integers(-50, 50, size).astype(float)
        if step % 7 == 1:
            v = np.eye(size)[step % size] * 100
        if step % 11 == 2:
            v = np.zeros(size)
        if step % 13 == 3:
            v = vectors[:, step % size] * 30
        if step % 17 == 4:
            v *= 1e-9
        d, vectors = updated(d, vectors, v)
        whole += np.outer(v, v)
    assert d == pytest.approx(np.linalg.eigvalsh(whole), rel=1e-9, abs=1e-9 * d[-1])
    assert vectors.T @ vectors == pytest.approx(np.eye(size), abs=1e-10)
    assert (vectors * d) @ vectors.T == pytest.approx(whole, rel=1e-8, abs=1e-9 * d[-1])


def test_spectra_join():
    rng = np.random.default_rng(0)
    x = rng.integers(-100, 100, (90, 6)) @ rng.integers(-2, 3, (6, 6)) + 1_000
    whole = Spectrum(6)
    for part in np.split(x, [1, 2, 30, 31]):
        one = Spectrum(6)
        for row in part:
            one.add(row)
        whole.merge(Spectrum.read(*one.row(0)[1:]))
    whole.merge(Spectrum(6))
    scatter = np.cov(x.T, bias=True) * len(x)
    assert whole.n == 90 and (whole.sums == x.sum(axis=0)).all()
    assert whole.values == pytest.approx(np.linalg.eigvalsh(scatter), rel=1e-8, abs=1e-6)


def plain_whitening(x: np.ndarray, components: int = 4):
    fit = np.unique(x, axis=0).astype(float)
    values, vectors = np.linalg.eigh(np.cov(fit.T, bias=True).reshape(x.shape[1], -1))
    top = np.argsort(values)[::-1][:components]
    return len(fit), (x - fit.mean(axis=0)) @ vectors[:, top] / np.sqrt(values[top]), values[top] / values.sum()


@pytest.mark.parametrize("pieces", [1, 9])
def test_whitening_equals_plain_solution(spark, make, pieces):
    rng = np.random.default_rng(2)
    v = (rng.normal(size=(160, 12)) @ rng.normal(size=(12, 12)) / 8).astype(np.float32)
    v[40:80] = v[0]  # copies count once
    rows = [(i, [float(c) for c in row]) for i, row in enumerate(v)] + [(900, None), (901, [float("nan")] * 12), (902, [None] * 12), (None, [0.5] * 12)]
    got = whitening.report(table(make, rows).repartition(pieces)).collect()
    x = np.floor(256 * np.vstack([v, np.full((1, 12), 0.5)]).astype(np.float64)).astype(np.int64)
    n, want, explained = plain_whitening(x)
    assert {r["n"] for r in got} == {n} and len(got) == 4 * 161
    found = np.zeros((161, 4))
    for r in got:
        found[160 if r["vec_id"] is None else r["vec_id"], r["component"] - 1] = r["whitened"]
    assert np.abs(found) == pytest.approx(np.abs(want), abs=1e-9)
    sign = np.sign((found * want).sum(axis=0))
    assert found * sign == pytest.approx(want, abs=1e-9)
    fit = np.unique(x, axis=0)
    deviations = ((len(fit) * x - fit.sum(axis=0)) ** 2).sum(axis=1)
    assert all(r["deviation"] == deviations[160 if r["vec_id"] is None else r["vec_id"]] for r in got)
    assert all(r["explained"] == pytest.approx(explained[r["component"] - 1], rel=1e-9) for r in got)
    assert all(r["identity_error"] == got[0]["identity_error"] < 1e-9 for r in got)


def test_whitening_of_odd_tables(spark, make):
    assert whitening.report(table(make, [])).collect() == []
    assert whitening.report(table(make, [(1, None), (2, [float("inf")])])).collect() == []
    assert whitening.report(table(make, [(1, [0.5, 1.0]), (1, [0.5, 1.0])])).collect() == []  # no variance
    assert whitening.report(table(make, [(1, []), (2, [])])).collect() == []
    two = whitening.report(table(make, [(1, [1.0, 0.0, 0.0]), (2, [0.0, 1.0, 0.0])])).collect()
    assert sorted((r["vec_id"], r["component"], abs(r["whitened"])) for r in two) == [(1, 1, pytest.approx(1.0)), (2, 1, pytest.approx(1.0))]
    assert all(r["explained"] == pytest.approx(1.0) for r in two) and {r["deviation"] for r in two} == {2 * 256**2}
    mixed = whitening.report(table(make, [(1, [1.0]), (2, [0.0, 1.0]), (3, [0.5, 0.25])])).collect()
    assert {r["vec_id"] for r in mixed} == {1, 2, 3} and {r["component"] for r in mixed} == {1, 2}


def test_deviations_beyond_64_bits_stay_whole():
    model = whitening.Whitening.__new__(whitening.Whitening)
    model.n, model.sums = 2**20, np.array([0, 5], np.int64)
    x = np.array([[2**26, 0], [1, 1]], np.int64)
    assert model.deviation(x).tolist() == [2**63 - 1, (2**20) ** 2 + (2**20 - 5) ** 2]
