"""Page extraction, chat format and nearest vectors against plain Python."""

from __future__ import annotations

import hashlib
import html as entities
import json
import random
import re
import time
from collections import Counter

import numpy as np
import pytest

from foldmill.llm import chat, html, neighbours, queries, trees

# --- pages ------------------------------------------------------------------------------------------------


def article(source: str) -> str:
    body = re.search(r"<article>(.*)</article>", source, re.S)[1]
    body = re.sub(r"</?b>", "", body).replace("<br>", " ")
    return "\n".join(x for x in (" ".join(entities.unescape(t).split()) for t in re.split(r"</?(?:h1|p)>", body)) if x)


@pytest.fixture(scope="module")
def pages(spark):
    return spark.read.parquet("/root/testdata/sf0.01/pages.parquet")


@pytest.fixture(scope="module")
def model(pages):
    return html.fitted(pages)


def test_main_text_of_the_table(pages, model):
    sources = {r.page_id: r.html for r in pages.collect()}
    rows = html.extracted(pages, model).collect()
    assert sum(r.text == article(sources[r.page_id]) for r in rows) >= 0.99 * len(rows)


def test_unseen_layouts(pages, model):
    rng = random.Random(99)
    said = [x for r in pages.limit(80).collect() for x in re.findall(r"<p>([^<]{20,600})", r.html)]
    found = [html.known_parts(html.compose(rng, said, [" ".join(x.split()[:2]) for x in said])) for _ in range(200)]
    forest = html.Forest([p for p, _ in found])
    kept = forest.decode(2 * model.margins(forest.features()))
    main, chars = np.concatenate([m for _, m in found]), forest.chars
    assert (chars * kept * main).sum() > 0.93 * (chars * main).sum()
    assert (chars * kept * main).sum() > 0.93 * (chars * kept).sum()


def test_decoding_has_no_contradictions(pages, model):
    forest = html.Forest([html.Page(r.html) for r in pages.limit(40).collect()])
    kept = forest.decode(np.random.default_rng(0).normal(0, 3, len(forest.parent)))
    inside = ~forest.is_text & kept
    for node in np.flatnonzero(forest.is_text & kept):
        above, seen_out = forest.parent[node], False
        while above != forest.root[node]:
            seen_out |= not inside[above]
            assert not (seen_out and inside[above])
            above = forest.parent[above]


@pytest.mark.parametrize("source", ["", "plain", "<", "<<<a <b>>", "<p", "<!--", "<!-- x", "<script>var a='</p>'", "<a b=\"c", "</p></div>", "<p>a<p>b", "&amp;&#x41;&nope;", "<table><tr><td>a<td>b<tr><td>c</table>", "<div " * 500, "<b>" * 3000 + "x"])
def test_any_markup_is_read(source, model):
    page = html.Page(source)
    forest = html.Forest([page])
    assert isinstance(page.main_text(forest.decode(2 * model.margins(forest.features()))), str)


def plain_parents(source: str) -> list[int]:
    """The parents of a page's nodes by walking the whole stack at every tag."""
    parent, stack, names = [-1], [0], [""]
    for end, tag, text in re.findall(r"<(/?)(\w+)>|([^<]+)", source):
        if text:
            parent.append(stack[-1])
        elif end:
            at = max((i for i, x in enumerate(names) if x == tag), default=0)
            if at and (tag in html._STOPS or not any(x in html._STOPS for x in names[at + 1 :])):
                del stack[at:], names[at:]
        else:
            closes = ("p",) if tag in html.BLOCKS and tag not in html._CLOSES else html._CLOSES.get(tag, ())
            for i in range(len(names) - 1, 0, -1):
                if names[i] in closes:
                    del stack[i:], names[i:]
                    if tag != "tr":
                        break
                elif names[i] in html._STOPS:
                    break
            parent.append(stack[-1])
            stack.append(len(parent) - 1)
            names.append(tag)
    return parent


def soup(rng: random.Random, n: int, tags: str) -> str:
    return "".join(rng.choice(["x", f"<{t}>", f"<{t}>", f"</{t}>"]) for t in rng.choices(tags.split(), k=n))


def test_nesting_equals_a_walk_of_the_stack():
    rng = random.Random(4)
    for n in (3, 10, 40, 200) * 40:
        source = soup(rng, n, "p p b div li ul td th tr table dt dd span article h2 body")
        assert html.Page(source).parent == plain_parents(re.sub("x+", "x", source)), source


def test_sums_over_subtrees_and_ancestors():
    rng = random.Random(6)
    forest = html.Forest([html.Page(soup(rng, n, "p b div li ul")) for n in (0, 5, 60, 1)])
    values = np.arange(len(forest.parent)) % 7 + 1
    up, down = values.copy(), np.zeros(len(values))
    for i in range(len(values)):
        at, depth = i, 0
        while at != forest.root[i]:
            at, depth = forest.parent[at], depth + 1
            up[at] += values[i]
            down[i] += values[at]
        assert forest.depth[i] == depth
    assert forest.up(values).tolist() == up.tolist() and forest.down(values).tolist() == down.tolist()


def test_decoding_equals_all_assignments():
    rng, numbers = random.Random(8), np.random.default_rng(8)
    for n in [2, 3, 5, 7, 8, 9, 10, 10] * 4 + [12]:
        page = html.Page("")
        while len(page.parent) != n:
            page = html.Page(soup(rng, n, "p b div section"))
        forest = html.Forest([page])
        gain = html._grid(numbers.normal(0, 2, n))
        every = np.indices((3,) * n).reshape(n, -1)
        score, fine = np.zeros(every.shape[1]), np.ones(every.shape[1], bool)
        for i, (state, up) in enumerate(zip(every, every[forest.parent])):
            text, root = forest.is_text[i], i == 0
            fine &= ~((state == 0) & text)
            if not root:
                fine &= (up == 0) | ((up == 1) & (state != 0) & ((state == 1) | (not text))) | ((up == 2) & (state == 2))
            piece = html.TAGS[forest.tag[i]] in ("inline", "p", "h", "a")
            score += np.select([state == 1, state == 2], [gain[i], -gain[i]], -html.BEGIN_BELOW)
            score -= html.ENTER * ((state == 1) & ((up == 0) | root))
            score -= np.where(~np.bool_(root) & (state == 2) & (up == 1), html.PRUNE_PIECE if piece else html.PRUNE, 0)
        best = score[fine].max()
        found = (every == forest.states(gain)[:, None]).all(axis=0)
        assert fine[found].all() and score[found][0] == best


@pytest.mark.parametrize("piece", ["<b>", "<p><i>", "<div>", "</b><b>x", "<li><td>", "<table><tr>", "<script></script><i>"])
def test_a_long_page_of_open_tags_takes_linear_time(piece, model):
    seconds = []
    for size in (100_000, 800_000):
        began = time.process_time()
        page = html.Page(piece * (size // len(piece)) + "end")
        forest = html.Forest([page])
        page.main_text(forest.decode(2 * model.margins(forest.features())))
        seconds.append(time.process_time() - began)
    assert seconds[1] < 24 * seconds[0] + 2 and seconds[1] < 60


def test_page_edges(spark, make, model):
    rows = [(1, "u", None, "x"), (2, None, "", "x"), (None, "u", "<article><p>One two, three four.</p><p>Five&nbsp;six \n seven.</article>", "x"), (2, None, "", "x")]
    pages = make(rows, "page_id long, url string, html string, text string")
    got = [tuple(r) for r in html.report(pages).collect()]
    assert len(got) == 4 and got[0][2:] == ("", 0) and got[1][2:] == ("", 0)
    assert html.report(pages.limit(0)).count() == 0


def test_trees_as_sql_and_numpy_agree(spark, model):
    rng = np.random.default_rng(2)
    rows = [([float(a), float(b)], int(a + b * b > 1)) for a, b in rng.normal(0, 1, (400, 2))]
    fitted = trees.fit(spark.createDataFrame(rows, "features array<double>, label int"), rounds=5, depth=3)
    table = spark.createDataFrame([(*x, y) for x, y in rows], "f0 double, f1 double, label int").selectExpr(f"{fitted.sql(['f0', 'f1'])} AS m", "label").collect()
    assert np.allclose([r.m for r in table], fitted.margins(np.array([x for x, _ in rows])))
    assert np.mean([(r.m > 0) == r.label for r in table]) > 0.9
    assert trees.fit(spark.createDataFrame([([1.0], 1)], "features array<double>, label int")).sql(["f0"]) == "0.0D"


# --- chat -------------------------------------------------------------------------------------------------


def test_conversations_read_back(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    extra = spark.createDataFrame([(10**6, 0, "user", None), (10**6, 1, None, "<|end|>"), (10**6, 2, "assistant", "<\\|turn|> <|"), (10**6 + 1, None, "assistant", ""), (None, 0, "user", "x")], rows.schema)
    rows = rows.unionByName(extra)
    said = "</s>[INST] ok [/INST]"
    table: dict = {-1: [(0, "user", said), (1, "assistant", said)]}
    for r in rows.collect():
        table.setdefault(r.conv_id, []).append((-1 if r.turn is None else r.turn, r.role or "", r.text or ""))
    got = {r.conv_id: r for r in chat.report(rows).collect()}
    assert set(got) == set(table)
    for conv, turns in table.items():
        turns.sort()
        learned = "".join(t for _, role, t in turns if role == "assistant")
        r = got[conv]
        assert (r.n_turns, r.loss_chars) == (len(turns), len(learned))
        assert r.turns_sha256 == hashlib.sha256("".join(f"{role}\n{t}\n" for _, role, t in turns).encode()).hexdigest()
        assert r.loss_sha256 == hashlib.sha256(learned.encode()).hexdigest()
        assert r.formatted_chars == sum(len(chat.format_turn(role, t)[0]) for _, role, t in turns)


def test_marks_are_escaped_reversibly():
    rng = random.Random(0)
    for _ in range(3000):
        role, text = ("".join(rng.choice("<|\\>endturx") for _ in range(rng.randint(0, 9))) for _ in range(2))
        piece, a, b = chat.format_turn(role, text)
        assert chat.parse_turn(piece) == (role, text) and piece.count("<|") == 3
        assert chat.unescape(piece[a:b]) == (text if role == "assistant" else "")
    with pytest.raises(ValueError):
        chat.parse_turn("<|turn|>a<|text|>b<|end|><|turn|>")


def test_layouts_become_the_same_turns(make):
    layouts = [
        {"messages": [{"role": "human", "content": "q"}, {"role": "gpt", "content": "a"}]}, {"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}]}, {"prompt": "q", "response": "a"},
        {"instruction": "q", "output": "a"}, {"instruction": "q", "input": "", "output": "a"}, {"data": {"question": "q", "answer": "a"}}, {"system": None, "prompt": "q", "response": "a"},
    ]
    rows = [(i, json.dumps(x)) for i, x in enumerate(layouts)] + [(90, None), (91, "[1]"), (92, '{"messages": []}')]
    got = chat.canonical_turns(make(rows, "id long, record string"), ["id"]).collect()
    assert Counter(r.id for r in got) == Counter({i: 2 for i in range(len(layouts))})
    assert all((r.role, r.text) == (("user", "q"), ("assistant", "a"))[r.turn] for r in got)
    with pytest.raises(Exception, match="no mapping"):
        chat.canonical_turns(make([(1, '{"odd": 1}')], "id long, record string"), ["id"]).collect()


# --- vectors ----------------------------------------------------------------------------------------------


@pytest.mark.parametrize("block", [64, 2048])
def test_nearest_equal_brute_force(spark, sf_dir, block):
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    first = rows.first().embedding
    extra = [(100_000 + i, first) for i in range(60)] + [(200_000, None), (200_020, [0.0] * 64), (200_040, [float("nan")] * 64), (200_060, [None] * 64), (200_080, [float("inf")] * 64), (None, first), (300_000, first), (300_000, first), (400_000, [1.0, 2.0]), (400_001, [3.0, 4.0])]
    rows = rows.unionByName(spark.createDataFrame(extra, rows.schema))
    kept = [(r.vec_id, np.array(r.embedding, float)) for r in rows.collect() if r.embedding is not None and all(c is not None for c in r.embedding)]
    kept = [(i, v) for i, v in kept if np.isfinite(v).all() and v.any()]
    got: dict = {}
    for r in neighbours.nearest(rows, block=block).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    want: dict = {}
    for n, (i, v) in enumerate(kept):
        if i is not None and i % 20 == 0:
            near = sorted((-float((w * v).sum()), float("inf") if j is None else j) for m, (j, w) in enumerate(kept) if m != n and len(w) == len(v))[:20]
            want.setdefault(i, []).append(near)
    assert set(got) == set(want)
    for i, lists in want.items():
        if len(lists) == 1:
            assert [x[0] for x in got[i]] == list(range(1, len(lists[0]) + 1))
            assert [float("inf") if x[1] is None else x[1] for x in got[i]] == [b for _, b in lists[0]]
            assert np.allclose([x[2] for x in got[i]], [-a for a, _ in lists[0]], rtol=1e-13)


def test_wide_scales_and_nothing(make):
    rows = [(i, [10.0 ** (i % 30 - 15), -(10.0 ** (i % 7))]) for i in range(80)]
    found = neighbours.nearest(make(rows, "vec_id long, embedding array<double>"), block=16).collect()
    for q in (0, 20, 40, 60):
        near = sorted((-sum(a * b for a, b in zip(rows[q][1], v)), j) for j, v in rows if j != q)[:20]
        assert [r.vec_id for r in sorted(found, key=lambda r: r.rank) if r.query_id == q] == [j for _, j in near]
    assert neighbours.nearest(make([], "vec_id long, embedding array<double>")).count() == 0


@pytest.mark.parametrize("tasks", [1, 3, 16])
def test_grid_brings_each_pair_of_blocks_together_once(make, tasks):
    schema = "block long, dim int, rids binary, ids binary, named binary, vectors binary"
    blocks = lambda n, dim: [(i, dim, bytes(8), b"", b"", b"") for i in range(n)]
    asked, there = make([*blocks(7, 2), *blocks(1, 3)], schema), make([*blocks(11, 2), *blocks(2, 3), *blocks(2, 4)], schema)
    cells: dict = {}
    for r in neighbours.dealt(asked, there, tasks, held=3).collect():
        cells.setdefault((r.dim, r.row, r.column), ([], []))[r.side].append(r.block)
    assert all(len(mine) <= 3 for mine, _ in cells.values())
    pairs = Counter((dim, q, c) for (dim, _, _), (mine, others) in cells.items() for q in mine for c in others)
    assert pairs == Counter([(2, q, c) for q in range(7) for c in range(11)] + [(3, 0, 0), (3, 0, 1)])
    # a candidate is sent once for the query blocks of a row
    rows = len({row for dim, row, _ in cells if dim == 2})
    assert rows >= 3 and sum(len(others) for (dim, _, _), (_, others) in cells.items() if dim == 2) == rows * 11


def test_nearest_with_columns_of_its_own_names(make):
    rows = [(i, [float(i), 1.0], i, "x", 2, 3) for i in range(30)]
    plain = neighbours.nearest(make([r[:2] for r in rows], "vec_id long, embedding array<float>")).collect()
    named = neighbours.nearest(make(rows, "vec_id long, embedding array<float>, rid long, v string, dim int, block int")).collect()
    assert sorted(plain) == sorted(named) and len(plain) == 40


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, sf_dir, name):
    from oracle import difference

    assert difference(queries.QUERIES[name](spark, sf_dir), queries.ORACLES[name], sf_dir) is None


def test_query_names():
    assert sorted(int(re.match(r"op(\d+)_", name)[1]) for name in queries.QUERIES) == list(range(1, 14))
