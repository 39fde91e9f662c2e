import hashlib
import math
import re

import numpy as np
import pytest

from tickloom.llm import credentials, queries

HEX, CAPS = "0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"


def base(text):
    """The definition's three patterns, plainly."""
    out = []
    for m in re.finditer(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", text, re.I | re.A):
        if len(m.group(2)) >= 8:
            out.append((m.start(), 0, m.end(), m.group(2)))
    for m in re.finditer("AKIA[A-Z0-9]+", text):
        if len(m.group()) >= 16:
            out.append((m.start(), 1, m.end(), m.group()))
    for m in re.finditer("[0-9a-f]+", text):
        if len(m.group()) >= 32:
            out.append((m.start(), 2, m.end(), m.group()))
    return sorted(out)


ODD = (
    "PassWord = 'abcdefgh' token:12345678 token : \"1234567\" secret==xxxxxxxxx api_key=tokentoken=abc12345 apikey:'a/b+c=d.e-f_g' "
    "ſecret=abcdefghij toKen=abcdefghij password   password=  abcdefghijk AKIAAKIA1234567890 AKIA12 xAKIAABCDEFGHIJKLMNo "
    "deadbeefdeadbeefdeadbeefdeadbeef0 gdeadbeefdeadbeefdeadbeefdeadbeef éDEADBEEFdeadbeef " + "0a" * 40 + " password=" + " " * 300 + "x"
)


def test_base_rules_on_odd_texts():
    for text in (ODD, ODD[::-1], ODD.replace(" ", ""), ODD.replace(" ", "\n") * 2, "", "AKIA", "token=", "ü" + ODD):
        assert credentials.base_matches(text) == base(text)


def walk(automaton, value):
    """Log likelihood character by character."""
    state, total = 0, 0.0
    for c in value:
        symbol = credentials.SYMBOLS.index(c)
        total += automaton.chance[state, symbol]
        state = automaton.following[state, symbol]
    return total + automaton.chance[state, credentials.END]


def plain(text, model):
    """All spans of a text, every run by itself."""
    own = base(text)
    spans = [(a, k, b) for a, k, b, _ in own]
    n = sum(kind in credentials.KINDS for kind in model.kinds)
    for m in re.finditer("[A-Za-z0-9+/_.=-]+", text):
        if len(m.group()) < 8 or any(m.start() < b and a < m.end() for a, _, b, _ in own):
            continue
        value = m.group().strip(".-")
        at = m.start() + len(m.group()) - len(m.group().lstrip(".-"))
        if len(value) < 8 or not n:
            continue
        likely = [walk(a, value) + share for a, share in zip(model.automata, model.shares)]
        secret = sum(math.exp(x - max(likely)) for x in likely[:n])
        other = sum(math.exp(x - max(likely)) for x in likely[n:])
        if secret / (secret + other) > 0.5:
            spans.append((at, credentials.KINDS.index(model.kinds[int(np.argmax(likely[:n]))]), at + len(value)))
    return sorted(spans)


def values(rng, alphabet, size, n):
    return ["".join(rng.choice(list(alphabet), size)) for _ in range(n)]


def made_up(n=400):
    """Texts with labelled credentials, and 30 credentials that no base rule finds."""
    rng = np.random.default_rng(3)
    syllables = "the re in on ti at es en ed is an ou ly ver schaft keit tion".split()
    prose = [" ".join("".join(rng.choice(syllables, rng.integers(2, 7))) for _ in range(60)) for _ in range(n)]
    texts = [f"{t}. Card 4111 1111 1111 1111, on 2021-11-{i % 28 + 1:02d}, 129.38.82.{i % 200}, no. {10**9 + i * 7919}" for i, t in enumerate(prose)]
    keys, hexes = values(rng, CAPS, 16, n), values(rng, HEX, 40, n)
    for i in range(0, n, 4):
        texts[i] += f" AKIA{keys[i]} x"
        texts[i + 1] += f' token = "{hexes[i]}" x'
    hidden = values(rng, HEX, 28, 30)  # too short for the rule, and without a name before them
    for i, value in enumerate(hidden):
        texts[4 * i + 2] += f" ({value})."
    return texts, hidden


@pytest.fixture(scope="module")
def learned(spark):
    texts, hidden = made_up()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    return docs, texts, hidden, credentials.learn(docs)


def test_whole_results_against_plain_ones(spark, learned):
    docs, texts, hidden, model = learned
    assert set(model.kinds[:3]) == {"assign", "access", "hex"}
    found = {r.doc_id: [(s.start, credentials.KINDS.index(s.kind), s.end) for s in r.spans] for r in credentials.find(docs, model).collect()}
    assert found == {i: plain(t, model) for i, t in enumerate(texts)}


def test_unlabelled_credentials_are_found_and_nothing_else(spark, learned):
    docs, texts, hidden, model = learned
    added = [texts[r.doc_id][s.start : s.end] for r in credentials.find(docs, model).collect() for s in r.spans if not s.base]
    assert sorted(added) == sorted(hidden)


def test_query_against_the_definition(spark):
    sf = "/root/testdata/sf0.001"
    table = spark.read.parquet(f"{sf}/documents.parquet")
    texts = {r.doc_id: r.text or "" for r in table.collect()}
    model = credentials.learn(table)
    rows = queries.QUERIES["op13_credentials"](spark, sf).collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = base(texts[r.doc_id])
        joined = ",".join(f"{credentials.KINDS[k]}:{a}:{b}" for a, k, b, _ in want)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(k == i for _, k, _, _ in want) for i in range(3)]
        assert r.spans == ",".join(f"{credentials.KINDS[k]}:{a}:{b}" for a, k, b in plain(texts[r.doc_id], model))


def test_an_automaton_is_a_distribution_and_keeps_a_format():
    rng = np.random.default_rng(5)
    model = credentials.infer([f"AKIA{v}" for v in values(rng, CAPS, 16, 500)])
    assert np.allclose(np.exp(model.chance).sum(1), 1)
    assert len(model.chance) < 40  # 500 values of 20 characters have nearly 10,000 prefixes
    like, unlike = "AKIA" + values(rng, CAPS, 16, 1)[0], values(rng, CAPS, 20, 1)[0]
    assert walk(model, like) > walk(model, unlike) + 5 and walk(model, like) > walk(model, like.lower()) + 20
    many = [like, unlike, "", "a" * 100, "A", like * 9]
    assert np.allclose(model.score(many), [walk(model, v) for v in many])
    # a language with a loop: (ab)* is found from samples, and its states are few
    loop = credentials.infer(["ab" * int(n) for n in rng.geometric(0.2, 2000)])
    assert walk(loop, "ab" * 40) > walk(loop, "ab" * 40 + "a") + 3 and len(loop.chance) <= 5


def test_states_that_differ_are_not_merged():
    tree = credentials.Tree(["xa"] * 50 + ["yb"] * 50 + ["za"] * 50)
    x, y, z = (tree.children[0][c] for c in "xyz")
    limit = math.sqrt(0.5 * math.log(2 / 0.01))
    assert not tree.agree(x, y, limit) and tree.agree(x, z, limit)
    assert tree.merge_loss(x, z) == pytest.approx(0) and tree.merge_loss(x, y) == pytest.approx(100 * math.log(2))


def test_edge_rows(spark):
    data = [(1, None, 3), (None, "token=abcdefgh", 9), (2, "", 0), (2, "", 0), (3, "a1b2c3d4" * 100_000, 0), (4, "token=" + " " * 200_000, 0)]
    docs = spark.createDataFrame(data, "doc_id long, text string, value int").selectExpr("*", "'x' AS spans", "1 AS n")
    model = credentials.learn(docs)
    found = sorted(((r.doc_id or 0, [(s.start, s.end, s.base) for s in r.spans]) for r in credentials.find(docs, model).collect()))
    assert [f for f in found if f[0] != 3] == [(0, [(0, 14, True)]), (1, []), (2, []), (2, []), (4, [])]
    empty = docs.filter("false")
    assert credentials.find(empty, credentials.learn(empty)).count() == 0
    nothing = spark.createDataFrame([(1, "only words here deadbeefdeadbeef")], "doc_id long, text string")
    assert credentials.find(nothing, credentials.learn(nothing)).first().spans == []
