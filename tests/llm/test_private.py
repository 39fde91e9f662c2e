import hashlib
import math
import re

import numpy as np
import pytest

from tickloom.llm import private, queries


def luhn(digits):
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else sum(divmod(2 * d, 10))
    return total % 10 == 0


def base(text):
    """The definition's four patterns, plainly."""
    out = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append((m.start(), 0, m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m.group().split(".")):
            out.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m.group())
        if 14 <= len(d) <= 19 and luhn(d):
            out.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


ODD = (
    "a@b.c_d@e.f a@@b.c x.@y-.z.w@q @a.b é@é.com a@b 1.2.3.4.5.6.7.8 256.1.1.1 001.0002.3.4 0000000255.1.1.1 "
    "4111 1111 1111 1111 4111-1111-1111-1111-22 +1 (838) 555-9577 +1234 +1--------9 ++12 345 678 90 5500005555555559 "
    "٣٤٥ +49 30 1234567 1.2.3.999 7" + "9" * 50 + " " + "x" * 500 + "@long.example.com"
)


def test_base_rules_on_odd_texts():
    for text in (ODD, ODD[::-1], ODD.replace(" ", ""), ODD.replace(" ", "\n") * 2, "", "@", "+"):
        assert private.base_spans(text) == base(text)


def test_query_against_the_definition(spark):
    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = queries.QUERIES["op5_private"](spark, sf).collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = base(texts[r.doc_id])
        joined = ",".join(f"{private.KINDS[k]}:{a}:{b}" for a, k, b in want)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == i for _, k, _ in want) for i in range(4)]
        assert set(joined.split(",")) <= set(r.spans.split(","))


def made_up(spark):
    good = ["mail me at jo.doe@mail1.example.com", "call 838-555-9577 now", "write to jo at mail dot com please", "pay by card 4111 1111 1111 1111"]
    bad = ["order 1234567890123456 sent", "build 300.2.3.4 done"]
    texts = [f"{t} n{i}" for i in range(40) for t in good + bad]
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def test_model_adds_loose_spans_and_rejects_numbers(spark):
    model = private.learn(made_up(spark))
    assert [s[:4] for s in private.spans_of("call 838-555-9577 now", model)] == [(5, 3, 17, False)]
    assert [s[1] for s in private.spans_of("write to jo at mail dot com please", model)] == [0]
    assert private.spans_of("order 1234567890123456 sent", model) == []
    assert private.mask("a@b.com, 1.2.3.4!", model) == "[EMAIL], [IP]!"
    # the labelers agree with the truth behind these texts
    assert (model.chance[1, :, 1] > model.chance[0, :, 1]).all()


def test_edge_rows(spark):
    data = [(1, None, 3), (None, "a@b.com", 9), (2, "", 0), (2, "", 0), (3, "1 " * 50000, 100000)]
    docs = spark.createDataFrame(data, "doc_id long, text string, n_chars long").selectExpr("*", "'x' as spans")
    model = private.learn(docs)
    found = {r.doc_id: r.spans for r in private.find(docs, model).collect()}
    assert found[1] == [] and found[2] == [] and len(found[None]) == 1
    masked = {r.doc_id: r for r in private.masked(docs, model).collect()}
    assert masked[1].text is None and masked[1].n_chars == 3
    assert masked[None].text == "[EMAIL]" and masked[None].n_chars == 7 and masked[None].spans == "x"
    assert private.find(docs.filter("false"), private.learn(docs.filter("false"))).count() == 0


def plain_reliabilities(rows, rounds=50):
    """Expectation-maximisation, one candidate pattern and labeler after the other."""
    n_labelers = len(private.LABELERS)
    yes = {p: min(max(0.5 + 0.15 * sum(p[1:-1]), 0.05), 0.95) for p in rows}
    chance = {}
    for _ in range(rounds):
        for truth in (0, 1):
            for j in range(n_labelers):
                seen = {-1: 4.0 if truth == 0 else 1.0, 1: 4.0 if truth == 1 else 1.0}
                for p, n in rows.items():
                    if p[1 + j]:
                        seen[p[1 + j]] += n * (yes[p] if truth else 1 - yes[p])
                chance[truth, j] = {v: seen[v] / (seen[-1] + seen[1]) for v in (-1, 1)}
        share = {}
        for k in {p[0] for p in rows}:
            own = [p for p in rows if p[0] == k]
            share[k] = (1 + sum(rows[p] * yes[p] for p in own)) / (2 + sum(rows[p] for p in own))
        for p in rows:
            odds = math.log(share[p[0]] / (1 - share[p[0]]))
            odds += sum(math.log(chance[1, j][v] / chance[0, j][v]) for j, v in enumerate(p[1:-1]) if v)
            yes[p] = 1 / (1 + math.exp(-odds))
    return chance, yes


def loose(text, own):
    """The looser forms, each searched by itself."""
    found = []
    for kind, pattern in enumerate((private._SPELT, private._LONG_IP, private._CARD, private._LOCAL_PHONE, private._TOKEN, private._ACCOUNT)):
        for m in pattern.finditer(text):
            n_digits = len(re.sub("[^0-9]", "", m.group()))
            if kind != 2 or (13 <= len(m.group()) <= 40 and 13 <= n_digits <= 19):
                found.append((m.start(), kind, m.end()))
    out = []
    for a, k, b in sorted(found):
        if not any(a < y and x < b for x, _, y in own) and not any(a < y and x < b for x, _, y in out):
            out.append((a, k, b))
    return out


def planted():
    """Texts with base spans, with 60 spans that no base rule finds, and with numbers and words that only look like them."""
    rng = np.random.default_rng(8)
    words = "the in of that and river stone garden letter music window morning evening people house water".split()
    texts, wanted = [], []
    for i in range(240):
        text = " ".join(rng.choice(words, 30))
        number = "".join(map(str, rng.integers(0, 10, 10)))
        hexes = "".join(rng.choice(list("0123456789abcdef"), 40))
        more = {
            0: ("mail", f"jo.doe{i}@mail{i % 7}.example.com", True), 1: ("call", f"+1 (838) 555-{number[:4]}", True),
            2: ("secret", hexes, False), 3: ("call", f"838-555-{number[:4]}", False),
            4: ("order", f"9{number}12345", None), 5: ("commit", hexes, None), 6: ("build", "this-is-a-long-name-of-a-page-2021", None),
            7: ("address", f"10.{i % 250}.3.{i % 99}", True),
        }[i % 8]
        texts.append(f"{text} {more[0]} {more[1]} {text}")
        if more[2] is False:
            wanted.append((i, len(text) + len(more[0]) + 2, len(text) + len(more[0]) + 2 + len(more[1])))
    return texts, wanted


@pytest.fixture(scope="module")
def learned(spark):
    texts, wanted = planted()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    return docs, texts, wanted, private.learn(docs)


def test_votes_and_reliabilities_against_plain_ones(learned):
    docs, texts, _, model = learned
    rows = {}
    for text in texts:
        own = base(text)
        assert private.loose_spans(text, own) == loose(text, own)
        for strict, spans in ((True, own), (False, loose(text, own))):
            for a, k, b in spans:
                p = private.votes(text, a, k, b, strict)
                rows[p] = rows.get(p, 0) + 1
    chance, yes = plain_reliabilities(rows)
    order = sorted(rows)
    found, probable = private.reliabilities(np.array(order), np.array([rows[p] for p in order], float))
    assert np.allclose(probable, [yes[p] for p in order])
    assert np.allclose(found[:, :, 1], [[chance[t, j][1] for j in range(len(private.LABELERS))] for t in (0, 1)])
    assert np.allclose(found, model.chance)  # as Spark counted them


def test_whole_results_against_plain_ones(learned):
    docs, texts, _, model = learned
    for r in private.find(docs, model).collect():
        text = texts[r.doc_id]
        want = [(a, private.KINDS[k], b, True) for a, k, b in base(text)]
        for a, k, b in loose(text, base(text)):
            z = sum(model.weights[c] for c in private.cells(text, a, b, private.votes(text, a, k, b, False)))
            if 1 / (1 + math.exp(-z)) > 0.5:
                want.append((a, private.ALL_KINDS[k], b, False))
        assert [(s.start, s.kind, s.end, s.base) for s in r.spans] == sorted(want)


def test_precision_and_recall_beyond_the_base_rules(learned):
    docs, texts, wanted, model = learned
    added = sorted((r.doc_id, s.start, s.end) for r in private.find(docs, model).collect() for s in r.spans if not s.base)
    right = len(set(added) & set(wanted))
    assert right / len(added) >= 0.95 and right / len(wanted) >= 0.95, (len(added), right, len(wanted))


def test_fitted_weights_reach_the_wanted_probabilities():
    examples = [[1, 2], [1, 3], [1, 2, 4], [5]] * 20
    wanted = np.array([0.9, 0.2, 0.5, 0.7] * 20)
    weights = private.fit(examples, wanted)
    got = [1 / (1 + math.exp(-weights[c].sum())) for c in examples[:4]]
    assert np.allclose(got, wanted[:4], atol=0.05)


def test_account_numbers():
    assert private._account_check("GB82 WEST 1234 5698 7654 32") and not private._account_check("GB82 WEST 1234 5698 7654 33")
    text = "IBAN DE89 3704 0044 0532 0130 00, x"
    assert private.loose_spans(text, []) == [(5, 5, 32)]
    assert private.votes(text, 5, 5, 32, False)[:6] == (5, 0, 1, 1, 1, 1)
