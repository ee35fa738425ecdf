"""The training-data operators against brute force, exact round trips and held-out accuracy."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from docledger.llm import ann, chat, jaccard, lm, mixing, packing, quality, queries, rules, toxicity, urls
from docledger.llm.shared import WORD
from docledger.llm.textstats import text_stats

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"

#: Nulls, empties, repeats, a long text, odd white space and columns whose names clash with inner ones.
EDGE = [(1, None), (2, ""), (3, "a"), (3, "a"), (4, "one two three four five six " * 9), (4, "one two three four five six " * 9), (None, "lost words here"), (5, "x\u00a0y\u2003z \t\x0b\x0c\r\n Ünï İ"), (6, "long text of many words " * 4000), (7, "\n\n \n"), (8, "éa " * 60)]


@pytest.fixture(scope="session")
def edge(spark):
    df = spark.createDataFrame([(i, t, "en", None if i in (2, 5) else "s", 0) for i, t in EDGE], DOCS)
    return df.withColumns({c: F.lit("clash") for c in ("id", "key", "bundle", "group", "size", "copies", "score", "piece", "_id", "target", "rep")})


@pytest.fixture(scope="session")
def docs(spark):
    return queries.read(spark, SF, "documents")


@pytest.fixture(scope="session")
def labels(spark):
    return queries.read(spark, SF, "labels")


def words(t):
    return re.findall(WORD, t or "")


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)


# ---- op1, op5, op6 ---------------------------------------------------------------------------------------------


def test_severity_learns_ordered_grades():
    rng = random.Random(3)
    rows = []
    for _ in range(600):
        bad = rng.choice([0, 0, 1, 3, 6])
        text = " ".join([rng.choice("abcdefgh") * 3 for _ in range(30)] + ["vile"] * bad).encode()
        rows.append((0 if not bad else 1 if bad == 1 else 2, toxicity.feature_counts(text)))
    model = toxicity.fit_severity(rows, min_z=4)
    assert list(model.thresholds) == sorted(model.thresholds) and len(model.thresholds) == 2
    got = [model.score(("abc " * 20 + "vile " * n).encode())[0] for n in (0, 1, 3, 6)]
    assert got == sorted(got) and got[0] < 0.3 and got[3] > 1.5
    assert toxicity.fit_severity([(0, Counter())]).score(b"x") == (0.0, 0.0)


@pytest.mark.parametrize("per_side, markers, each", [(30, 1, 2), (1500, 200, 4)])
def test_toxicity_finds_rare_markers(per_side, markers, each):
    """Held-out rows by the production values: few rows, and a long tail of markers of which each row has a few."""
    rng = random.Random(5)
    bad = [f"{chr(97 + i % 26)}{chr(97 + i // 26)}z{i}" for i in range(markers)]
    some = lambda g, n: [(g, toxicity.feature_counts(" ".join([f"w{rng.randrange(3000)}" for _ in range(60)] + rng.choices(bad, k=each * g)).encode())) for _ in range(n)]
    model = toxicity.fit_severity(some(0, per_side) + some(1, per_side))

    def flagged(rows):
        texts = [b" ".join(w for w in x for _ in range(x[w]) if not w.startswith(b"^")) for _, x in rows]
        return sum(model.score(t)[1] >= model.flag_at for t in texts) / len(texts)

    assert model.weights and flagged(some(1, 300)) > 0.9 and flagged(some(0, 300)) < 0.1


def test_severity_is_the_maximum_of_the_likelihood():
    """Against the likelihood written out row by row: its gradient by differences, and no better point near the fit."""
    rng = random.Random(6)
    rows = []
    for _ in range(300):
        n = rng.choice([0, 0, 1, 2, 4])
        grade = min(2, max(0, round(n / 2 + rng.gauss(0, 0.5))))
        rows.append((grade, toxicity.feature_counts(" ".join(["vile"] * n + ["foul"] * (n // 2) + ["calm", "word"]).encode())))
    model = toxicity.fit_severity(rows, min_z=3, ridge=1e-3, steps=3000)
    names = sorted(model.weights)

    def loss(p):
        w, theta = dict(zip(names, p)), [*p[len(names) :]]
        total = 0.0
        for grade, x in rows:
            eta = sum(w.get(f, 0.0) * math.log1p(c) for f, c in x.items())
            above = [1.0, *[1 / (1 + math.exp(t - eta)) for t in theta], 0.0]
            total -= math.log(above[grade] - above[grade + 1])
        return total / len(rows) + 1e-3 * sum(v * v for v in w.values()) / 2

    at = np.array([*[model.weights[f] for f in names], *model.thresholds])
    steps = np.eye(len(at)) * 1e-4
    assert len(model.thresholds) == 2 and max(abs(loss(at + d) - loss(at - d)) / 2e-4 for d in steps) < 2e-3
    assert all(loss(at + np.array([rng.gauss(0, 0.05) for _ in at])) > loss(at) for _ in range(20))


def test_quality_is_the_quadratic_discriminant():
    """Scores against densities by the inverse and the determinant of each class's covariance."""
    rng = np.random.default_rng(2)
    x = np.r_[rng.normal(size=(60, 4)), rng.normal(1, 2, size=(90, 4))]
    y = np.r_[np.zeros(60, int), np.ones(90, int)]
    model = quality.fit_quadratic(x, y, (0.4, 0.6), pooled=0.2, ridge=0.05)
    parts = [x[y == k] for k in (0, 1)]
    own = [np.cov(p.T) for p in parts]
    both = sum(s * (len(p) - 1) for s, p in zip(own, parts)) / (len(x) - 2)
    logs = []
    for p, s, prior in zip(parts, own, (0.4, 0.6)):
        c = 0.95 * (0.8 * s + 0.2 * both) + 0.05 * np.diag(np.diag(both))
        d = x - p.mean(0)
        logs.append(-0.5 * np.einsum("ij,jk,ik->i", d, np.linalg.inv(c), d) - 0.5 * np.log(np.linalg.det(c)) + np.log(prior))
    assert np.allclose(model.score(x), 1 / (1 + np.exp(logs[0] - logs[1])))


def test_toxicity_on_documents(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = queries.read(spark, sf, "documents"), queries.read(spark, sf, "labels")
    train = labels.where("doc_id % 3 <> 0")
    model = toxicity.severity_model(docs, train, graver_col="quality")
    got = toxicity.score_severity(docs, model).withColumnRenamed("toxic", "flag").join(labels.where("doc_id % 3 = 0"), "doc_id")
    rows = got.select("flag", "toxic").collect()
    assert sum(r.flag == bool(r.toxic) for r in rows) / len(rows) > 0.9


def test_quality_held_out(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = queries.read(spark, sf, "documents"), queries.read(spark, sf, "labels")
    out = quality.score_quality(docs, quality.quality_model(docs, labels)).join(labels, "doc_id").where("held_out").collect()
    assert all(0 <= r.score <= 1 for r in out) and all((zlib.crc32(str(r.doc_id).encode()) % 5 == 0) == r.held_out for r in out)
    assert sum(r.predicted == r.quality for r in out) / len(out) > 0.9


def test_classifiers_on_edges(spark, edge, docs, labels):
    n = len(EDGE)
    model = quality.quality_model(docs, labels)
    assert quality.score_quality(edge, model).where("score between 0 and 1").count() == n
    assert quality.score_quality(edge.limit(0), model).count() == 0
    assert quality.quality_model(docs, labels.limit(0)).means == () and quality.keep_good(edge, quality.quality_model(docs, labels.limit(0))).count() == n
    assert toxicity.score_severity(edge, toxicity.severity_model(docs, labels.limit(0))).where("expected_severity = 0").count() == n
    assert rules.judge_rules(edge).count() == n and rules.judge_rules(edge.limit(0)).count() == 0


def brute_stats(t):
    t = t or ""
    w = words(t)
    lines = [x for x in t.split("\n") if words(x)]
    tri = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    seen = Counter(tri)
    marks = {i + j for i, x in enumerate(tri) if seen[x] > 1 for j in range(3)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(marks)


def test_rules_base(spark, docs, edge):
    for df in (docs, edge):
        got = Counter((r.doc_id, *r[1:6], r.base_failed) for r in rules.judge_rules(df).collect())
        want = Counter()
        for r in df.select("doc_id", "text").collect():
            s = brute_stats(r.text)
            want[(r.doc_id, *s, s[0] < 50 or 100 * s[4] > 50 * s[0])] += 1
        assert got == want


def brute_em(texts, strength=4.0, accuracy=0.75):
    """Expectation-maximisation text by text and rule by rule."""
    p = [(sum(x == 1 for x in v) + 1) / (sum(x != 0 for x in v) + 2) for v in texts]
    for _ in range(300):
        share = (sum(p) + strength / 2) / (len(p) + strength)
        says = {}
        for j in range(len(texts[0])):
            for good in (True, False):
                w = [q if good else 1 - q for q in p]
                bad = sum(x for x, v in zip(w, texts) if v[j] == -1) + strength * (1 - accuracy if good else accuracy)
                says[j, good] = bad / (sum(x for x, v in zip(w, texts) if v[j]) + strength)
        new = []
        for v in texts:
            odds = share / (1 - share)
            for j, x in enumerate(v):
                if x:
                    a, b = says[j, True], says[j, False]
                    odds *= a / b if x == -1 else (1 - a) / (1 - b)
            new.append(odds / (1 + odds))
        p = new
    return p


def test_rules_em_is_brute_force():
    rng = random.Random(4)
    texts = []
    for _ in range(120):
        good = rng.random() < 0.7
        texts.append(tuple(0 if rng.random() < 0.2 else 1 if (rng.random() < (0.9 if j < 5 else 0.5)) == good else -1 for j in range(rules.N_RULES)))
    post = rules.fit_label_model(Counter(map(rules.encoded, texts)))
    assert np.allclose([post[rules.encoded(v)] for v in texts], brute_em(texts), atol=1e-6)


def test_rules_em_finds_the_bad_group():
    all_good, n = rules.encoded((1,) * 9), rules.N_RULES
    bad = rules.encoded((1, -1, -1, 1, 1, 1, -1, 1, 1))
    noise = {rules.encoded(tuple(-1 if i == j else 1 for i in range(n))): 30 for j in (0, 3, 7)}  # fallible rules, each alone
    post = rules.fit_label_model({all_good: 900, bad: 100, **noise})
    assert post[all_good] > 0.9 > 0.5 > post[bad] and all(post[p] > 0.5 for p in noise) and rules.decoded(bad) == (1, -1, -1, 1, 1, 1, -1, 1, 1)
    assert rules.fit_label_model({}) == {} and rules.fit_label_model({all_good: 5})[all_good] > 0.5


def test_rules_em_invents_no_bad_class():
    """Texts of which none is bad, but many are short, and the short ones vary more in the rest: none is rejected, at any size."""
    code = lambda **v: rules.encoded(tuple(v.get(f"r{j}", 1) for j in range(rules.N_RULES)))
    counts = {code(): 30000, code(r7=0): 5400, code(r3=-1): 1200, code(r0=0): 1100, code(r0=-1): 970, code(r0=0, r7=0): 680, code(r0=-1, r7=0): 640, code(r0=-1, r7=-1): 45, code(r0=-1, r6=0): 200, code(r8=0): 300}
    for times in (1, 5, 1000):
        post = rules.fit_label_model({k: n * times for k, n in counts.items()})
        assert sum(n for k, n in counts.items() if post[k] < 0.5) <= 45


def test_rules_beat_all_must_pass(spark):
    """The posterior parts from the filter that every rule must pass, and agrees better with the labels."""
    sf = "/root/testdata/sf0.1"
    rows = queries.read(spark, sf, "documents").join(queries.read(spark, sf, "labels"), "doc_id").select("doc_id", "text", "quality")
    out = rules.judge_rules(rows.drop("quality")).join(rows, "doc_id").where("not base_failed").collect()
    must = [-1 not in rules.votes(text_stats((r.text or "").encode())) for r in out]
    agrees = [sum(bool(k) == (r.quality == 1) for k, r in zip(kept, out)) / len(out) for kept in ([r.kept for r in out], must)]
    assert sum(r.kept != m for r, m in zip(out, must)) > 100 and agrees[0] > 0.99 and agrees[0] > agrees[1] + 0.03


def test_rules_keep_good_documents(spark):
    sf = "/root/testdata/sf0.01"
    out = rules.judge_rules(queries.read(spark, sf, "documents")).join(queries.read(spark, sf, "labels"), "doc_id").where("not base_failed").collect()
    assert sum(r.kept for r in out if r.quality == 1) / sum(r.quality == 1 for r in out) > 0.98
    assert sum(r.kept for r in out if r.quality == 0) / max(1, sum(r.quality == 0 for r in out)) < 0.2


# ---- op2 -------------------------------------------------------------------------------------------------------


def brute_lm(rows, strengths=(2000.0, 10.0)):
    """Scores by dictionaries, one token at a time, with the production order and strengths."""
    toks = [["E", *[b"w" + w for w in lower(t or "").encode().split()], "E"] for _, t in rows]
    held = [zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2 for i, _ in rows]
    c = [Counter(), Counter(), Counter()]
    for h, ts in zip(held, toks):
        for m in range(1, 4 if not h else 0):
            c[m - 1].update(tuple(ts[e - m + 1 : e + 1]) for e in range(max(1, m - 1), len(ts)))
    n, v, out = sum(c[0].values()), len(c[0]), []

    def p(h, w):
        if not h:
            return (c[0][(w,)] + 1) / (n + v + 1)
        s, before = strengths[len(h) - 1], c[len(h) - 1][h]
        return (c[len(h)][(*h, w)] + s * p(h[1:], w)) / (before + s) if before else p(h[1:], w)

    for (i, _), h, ts in zip(rows, held, toks):
        base = sum(math.log10(p((), w)) for w in ts[1:])
        score = sum(math.log10(p(tuple(ts[max(0, k - 2) : k]), ts[k])) for k in range(1, len(ts)))
        out.append((i, h, len(ts) - 1, sum(c[0][(w,)] > 0 for w in ts[1:]), n, base, score))
    return out


def test_lm_is_the_dictionary_model(spark, docs, edge):
    for df in (docs, edge):
        rows = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
        key = lambda r: (r[0] is None, r[0] or 0, r[2], round(r[6], 6))
        want = sorted(brute_lm(rows), key=key)
        for size in (12 << 20, 20_000):
            got = sorted((tuple(r) for r in lm.score_corpus(df, bundle_chars=size).collect()), key=key)
            assert [g[:5] for g in got] == [w[:5] for w in want]
            assert np.allclose([g[5:] for g in got], [w[5:] for w in want])
    assert lm.score_corpus(docs.limit(0)).count() == 0


def machine_of(texts, order=3, strengths=(2000.0, 10.0)):
    g = lm.grams(*lm.tokenised(pa.array([t.encode() for t in texts])), order)
    counts = lm._own_counts(g, np.ones(len(texts), bool))
    each = np.split(counts, np.cumsum([len(k) for k in g.keys])[:-1])
    return g, lm.Automaton.build(g, each, int(each[0].sum()), int((each[0] > 0).sum()), strengths)


def test_lm_failure_arcs_and_mass(docs):
    """Every failure arc leads to a shorter context; in every state the probabilities of all next tokens sum to one."""
    texts = [r.text or "" for r in docs.limit(25).collect()]
    g, machine = machine_of(texts)
    v = machine.tokens
    length = np.r_[0, np.full(v, 1), np.full(len(machine.fail) - 1 - v, 2)]
    assert (length[machine.fail[1:]] < length[1:]).all() and (length[machine.fail[1 + v :]] == 1).all()
    assert set(length[machine.target]) == {2}
    rng = np.random.default_rng(0)
    for state in [0, *rng.choice(np.unique(machine.arc // v), 40)]:
        gained, _ = machine.step(np.full(v, state), np.arange(v))
        fails, s = 0.0, state
        while s:
            fails, s = fails + machine.fail_weight[s], machine.fail[s]
        unknown = 1 / (int(g.sizes.sum()) + v + 1)  # the class of all other tokens
        assert abs((10**gained).sum() + 10**fails * unknown - 1) < 1e-9


def test_lm_stretches_carry_the_state():
    """However a text is cut into stretches, the walk is the same; an unseen token leads back to the empty context."""
    texts = ["a b c a b c a b d " * 40, "a b", "", "c c c c"]
    g, machine = machine_of(texts)
    whole = machine.walk(g, 3, 10**6)
    for stretch in (1, 2, 3, 7, 256):
        assert np.allclose(machine.walk(g, 3, stretch), whole)
    for order, strengths in ((1, ()), (2, (5.0,)), (4, (9.0, 3.0, 1.0))):
        g, machine = machine_of(texts, order, strengths)
        assert np.allclose(machine.walk(g, order, 2), machine.walk(g, order, 10**6))


def test_lm_tells_texts_that_occur_twice(spark):
    """Per token, texts that training has twice score above nine tenths of the texts that it has once."""
    rng = random.Random(8)
    made = lambda: " ".join(f"w{int(rng.paretovariate(0.4)) % 40_000}" for _ in range(300))
    once, twice = [made() for _ in range(200)], [made() for _ in range(30)]
    rows = [(i, t) for i, t in enumerate(once + twice + twice) if zlib.crc32(str(i).encode()) % 7 != 2]
    texts = Counter(t for _, t in rows)
    out = lm.score_corpus(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    of = dict(rows)
    rate = {k: [r.score / r.n_tokens for r in out if texts[of[r.doc_id]] == k] for k in (1, 2)}
    assert np.mean(np.array(rate[2]) > np.quantile(rate[1], 0.9)) > 0.9


def test_lm_gains_on_held_out(spark):
    out = lm.score_corpus(queries.read(spark, "/root/testdata/sf0.01", "documents")).where("held_out").agg(F.sum("score").alias("s"), F.sum("base_score").alias("b")).first()
    assert out.s > 0.95 * out.b


# ---- op3 -------------------------------------------------------------------------------------------------------


def test_packing_round_trip(spark, docs, edge):
    from tokenizers import Tokenizer

    path = queries.tokenizer_path()
    tok = Tokenizer.from_file(path)
    for df, length in ((docs, 2048), (edge, 2048), (edge, 64)):
        rows = packing.pack_documents(df, path, length, with_ids=True).collect()
        want = Counter()
        for r in df.select("doc_id", "text").collect():
            ids = np.array([*tok.encode(r.text or "", add_special_tokens=False).ids, 0], "<u4")
            for p, s in enumerate(range(0, len(ids), length)):
                part = ids[s : s + length].tobytes()
                want[(r.doc_id, p, s, len(part) // 4, zlib.crc32(part), part)] += 1
        assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32, bytes(r.ids)) for r in rows) == want
        bins = {}
        for r in rows:
            bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
        for b in bins.values():
            at = 0
            for offset, n in sorted(b):
                assert offset == at
                at += n
            assert at <= length
        assert len(bins) <= 1.02 * math.ceil(sum(r.length for r in rows) / length) + 1
    assert packing.pack_documents(docs.limit(0), path).count() == 0


@pytest.mark.parametrize("change", [None, "Lowercase", "regex"])
def test_packing_by_any_tokenizer(spark, docs, tmp_path, change):
    """A tokenizer of another make is seen, and its ids are its own."""
    import json

    from tokenizers import Tokenizer

    told = json.load(open(queries.tokenizer_path()))
    if change == "Lowercase":
        told["normalizer"]["normalizers"].pop()
    if change == "regex":
        told["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"] = r"\\S+"
    path = str(tmp_path / "tokenizer.json")
    json.dump(told, open(path, "w"))
    assert isinstance(packing._ids(path), packing._Whole if change else packing._Ids)
    tok, rows = Tokenizer.from_file(path), docs.limit(40).select("doc_id", "text")
    want = Counter((r.doc_id, zlib.crc32(np.array([*tok.encode(r.text or "", add_special_tokens=False).ids, 0], "<u4").tobytes())) for r in rows.collect())
    assert Counter((r.doc_id, r.ids_crc32) for r in packing.tokenized(rows, path, 10**6).collect()) == want


def test_packing_small_latin_runs_need_the_merges_alone():
    """Runs of small Latin letters skip the steps before the merges, punctuation is encoded once, and ids stay those of whole texts."""
    import pyarrow as pa
    from tokenizers import Tokenizer

    rng = random.Random(8)
    tok = Tokenizer.from_file(queries.tokenizer_path())

    class Seen:
        model, get_vocab, texts = tok.model, tok.get_vocab, []

        def encode_batch_fast(self, texts, add_special_tokens):
            self.texts += texts
            return tok.encode_batch_fast(texts, add_special_tokens=add_special_tokens)

    ids = packing._Ids(Seen(), bound=500)
    run = lambda: "".join(rng.choices("abcdefghijklmnoprstuvwyzßéèñ", k=rng.randint(1, 9))) + rng.choice(["", "", ".", "###"])
    often = [run() for _ in range(50)]
    odd = ["", " ", "Élan vital.", "e\u0301te\u0301. o\u0338=", "<|endoftext|>. A.b <|x", "it's 4²", "Привет, мир", "\u00a0x\u0085"]
    for _ in range(4):
        texts = [" ".join([run() for _ in range(40)] + rng.choices(often, k=20)) for _ in range(50)] + odd
        want = [np.array(tok.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
        assert ids.of(pa.array(["not seen", *texts]).slice(1)) == want
    assert len(ids.known) and not any(t.isascii() and t.islower() and t.isalpha() for s in ids.tokenizer.texts for t in s.split(" "))
    assert len(ids.tokenizer.texts) < 60


def test_packing_search():
    rng = random.Random(5)
    for sizes in ([60, 60, 60, 40, 40, 40], [70] * 5 + [30] * 5, [rng.randint(1, 100) for _ in range(2000)], [51] * 40, [], [100, 100], [1] * 250):
        bins = packing.pack_lengths(sizes, 100)
        assert sorted(i for b in bins for i in b) == list(range(len(sizes))) and all(sum(sizes[i] for i in b) <= 100 for b in bins)
    assert len(packing.pack_lengths([60, 60, 60, 40, 40, 40], 100)) == 3


def test_packing_search_empties_bins():
    """From bins in order of arrival, the search alone gets within a hundredth of what the tokens need."""
    rng = random.Random(6)
    for sizes in ([min(2048, int(rng.lognormvariate(6, 1)) + 1) for _ in range(6000)], [rng.randint(200, 900) for _ in range(6000)]):
        bins = packing.Bins(2048)
        bins.in_order([(n, i) for i, n in enumerate(sizes)])
        first, squares = len(bins.items), sum(f * f for f in bins.fill)
        bins.improve()
        left, least = sum(map(bool, bins.items)), math.ceil(sum(sizes) / 2048)
        assert left < 0.95 * first and left <= 1.01 * least and sum(f * f for f in bins.fill) > squares
        assert sorted(x for b in bins.items for x in b) == sorted((n, i) for i, n in enumerate(sizes))


def test_packing_steps():
    """A move, an exchange of one for one, and one of two for one; each makes the sum of squared fills grow."""
    for items, after in (([[(60, 0)], [(30, 1)]], [[30, 60], []]), ([[(45, 2), (35, 3)], [(50, 0), (30, 1)]], [[45, 50], [30, 35]]), ([[(65, 0), (20, 1)], [(18, 2), (17, 3)]], [[17, 18, 65], [20]])):
        bins = packing.Bins(100, [list(b) for b in items])
        before = sum(f * f for f in bins.fill)
        bins._listed(0, True)
        assert bins._step(1) and [sorted(x[0] for x in b) for b in bins.items] == after
        assert sum(f * f for f in bins.fill) > before and bins.fill == [sum(b) for b in after]
    bins = packing.Bins(100, [[(99, 0)], [(2, 1)]])
    bins._listed(0, True)
    assert not bins._step(1)


# ---- op4 -------------------------------------------------------------------------------------------------------


def brute_classes(rows, threshold=0.8):
    sets = []
    for _, t in rows:
        w = lower(t or "").encode().split()
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    links, root = [0] * len(rows), list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and rows[i][0] is not None and rows[j][0] is not None and both / len(sets[i] | sets[j]) >= threshold:
                links[i] += 1
                links[j] += 1
                root[max(find(i), find(j))] = min(find(i), find(j))
    least = {}
    for i, (d, _) in enumerate(rows):
        least[find(i)] = d if find(i) not in least or d is None else min(x for x in (least[find(i)], d) if x is not None)
    return Counter((d, least[find(i)], links[i]) for i, (d, _) in enumerate(rows))


def near_copies(n=60, seed=2):
    rng = random.Random(seed)
    base = [f"w{rng.randint(0, 500)}" for _ in range(150)]
    rows = []
    for i in range(n):
        w = list(base)
        for _ in range(rng.randint(0, 4)):
            w[rng.randrange(len(w))] = f"z{rng.randint(0, 9**6)}"
        rows.append((i, " ".join(w)))
    return rows + [(1000 + i, " ".join(f"q{rng.randint(0, 9**6)}" for _ in range(80))) for i in range(20)] + [(2000 + i, rows[0][1].upper() if i else rows[0][1]) for i in range(5)]


def test_jaccard_is_brute_force(spark, docs, edge):
    made = spark.createDataFrame(near_copies(), "doc_id long, text string")
    for df in (docs, edge, made):
        rows = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
        assert Counter(tuple(r) for r in jaccard.jaccard_classes(df).collect()) == brute_classes(rows)
    split = jaccard.jaccard_classes(made, block=7).collect()  # groups dealt over blocks
    assert Counter(map(tuple, split)) == brute_classes(near_copies())
    assert jaccard.jaccard_classes(docs.limit(0)).count() == 0
    kept = {r.doc_id for r in jaccard.keep_one(made).collect()}
    assert kept == {c for _, c, _ in brute_classes(near_copies())}


def test_prefix_is_shortened_until_the_measured_recall():
    levels = jaccard.planted_levels([40, 100, 300, 1000] * 500, 0.8, 32)
    assert levels.shape == (2000, 32) and levels.max() == jaccard.DEPTH
    lengths = [jaccard.prefix_length(levels, r) for r in (0.5, 0.99, 0.999, 0.9999, 0.999999)]
    assert lengths[0] == 8 and lengths == sorted(lengths, reverse=True) and lengths[-1] < 6
    for length, r in zip(lengths, (0.5, 0.99, 0.999, 0.9999)):  # the pairs themselves meet at that rate
        assert (levels.max(1) >= length).mean() >= r - 3 * math.sqrt(r * (1 - r) / len(levels)) - 1e-9
    assert jaccard.prefix_length(jaccard.planted_levels([300] * 200, 0.8, 2), 0.9999) == 1


def test_planted_pairs_at_the_threshold_are_found(spark):
    """Pairs of texts whose similarity is just above 0.8: the forest finds them all, and pairs just below are no links."""
    rng = random.Random(12)
    rows = []
    for i in range(400):
        w = [f"w{rng.randrange(10**6)}" for _ in range(94)]  # 90 n-grams; ten words at an end change ten of them
        below = i % 2
        rows += [(2 * i, " ".join(w)), (2 * i + 1, " ".join(w[: 84 - below] + [f"z{rng.randrange(10**6)}" for _ in range(10 + below)]))]
    out = {r.doc_id: r for r in jaccard.jaccard_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i in range(400):
        assert out[2 * i + 1].n_links == (1 if i % 2 == 0 else 0) and (out[2 * i + 1].class_id == 2 * i) == (i % 2 == 0)


def test_forest_runs_over_partitions(spark):
    """Ties are the same however the sorted signatures fall into partitions."""
    made = spark.createDataFrame(near_copies(200), "doc_id long, text string")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for parts in ("1", "40"):
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
            assert Counter(map(tuple, jaccard.jaccard_classes(made).collect())) == brute_classes(near_copies(200))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_one_id_with_several_texts(spark):
    """Texts are classed by themselves, and none of them is lost where ids repeat."""
    rng = random.Random(9)
    a, b, c = (" ".join(f"{x}{rng.randrange(10**6)}" for _ in range(80)) for x in "abc")
    rows = [(1, a), (1, b), (2, a + " more"), (3, b + " more"), (1, c), (4, c), (4, c), (5, a.upper())]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert Counter(tuple(r) for r in jaccard.jaccard_classes(df).collect()) == brute_classes(rows)
    assert Counter(tuple(r) for r in jaccard.jaccard_classes(df, block=1).collect()) == brute_classes(rows)
    assert sorted(tuple(r) for r in jaccard.keep_one(df).collect()) == sorted([(1, a), (1, b), (1, c)])


# ---- op7 -------------------------------------------------------------------------------------------------------


def brute_url(url, table):
    if not url or "://" not in url:
        return "", "", None, "allow"
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    host = lower(host)
    fits = []
    for verdict, rule in table:
        h, _, p = rule.partition("/")
        if (host == h or host.endswith("." + h)) and (path.startswith("/" + p) or "/" not in rule):
            fits.append((len(rule), len(h), verdict == "block", rule, verdict))
    best = max(fits, default=None)
    return host, path, best and best[3], best[4] if best else "allow"


URLS = ["http://A.Net/x", "https://sub.example.net/en/1?q#f", "example.net/en/", None, "", "http://", "ftp://net", "http://net/", "http://xnet/", "http://example.com/de/", "http://a.org/fr", "http://a.org/fr/", "x://a.b?c://d/e", "http://example.net/en", "http://a..net/\nz", "http://b.net#/en/"]


def test_urls(spark):
    rules_ = [*queries.URL_RULES, ("block", "a.org/fr/"), ("allow", "b.net/"), ("block", "xnet")]
    rows = [(i, u) for i, u in enumerate(URLS)] + [(0, URLS[0])] + [(r.page_id, r.url) for r in queries.read(spark, SF, "pages").collect()]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, host string")
    got = Counter(tuple(r) for r in urls.judge_urls(df, urls.rule_table(spark, rules_)).collect())
    assert got == Counter((i, *brute_url(u, rules_)) for i, u in rows)
    assert urls.judge_urls(df.limit(0), urls.rule_table(spark, rules_)).count() == 0
    assert urls.judge_urls(df, urls.rule_table(spark, rules_).limit(0)).where("verdict = 'allow' and rule is null").count() == len(rows)


def test_cascade_is_exact(spark):
    listed, universe = spark.range(500).select(F.xxhash64("id").alias("key")), spark.range(5000).select(F.xxhash64("id").alias("key"))
    cascade = urls.build_cascade(listed, universe, bits_per_key=2)
    assert len(cascade.levels) > 2
    keys = np.array([r.key for r in universe.collect()], np.int64).view(np.uint64)
    inside = {r.key for r in listed.collect()}
    assert cascade.has(keys).tolist() == [int(k) in inside for k in keys.view(np.int64)]
    with pytest.raises(ValueError):
        urls.build_cascade(listed, universe, max_bytes=10)


# ---- op8 -------------------------------------------------------------------------------------------------------


def brute_targets(sizes, weights=(1, 2, 3), cap=3):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, full = sum(sizes.values()), set()
    while True:
        rest = [s for s in sizes if s not in full]
        level = (total - sum(cap * sizes[s] for s in full)) / sum(w[s] for s in rest) if rest else 0
        over = {s for s in rest if level * w[s] > cap * sizes[s]}
        if not over:
            return {s: cap * sizes[s] if s in full else level * w[s] for s in sizes}
        full |= over


def test_mixing(spark, docs, edge):
    small = docs.withColumn("source", F.when(F.col("doc_id") < 3, "tiny").when(F.col("doc_id") % 9 == 0, None).otherwise(F.col("source")))
    for df in (docs, small, edge):
        out = mixing.mixed_copies(df).collect()
        assert len(out) == df.count() and sorted(map(tuple, out), key=str) == sorted(map(tuple, mixing.mixed_copies(df.repartition(5)).collect()), key=str)
        source = {}
        for r in df.select("doc_id", "source", "text").collect():
            source[r.source] = source.get(r.source, 0) + len(words(r.text))
        want = brute_targets(source)
        got = {}
        of = {(r.doc_id, len(words(r.text))): r.source for r in df.select("doc_id", "source", "text").collect()}
        for r in out:
            s = of[r.doc_id, r.size]
            assert r.source_size == source[s] and r.target == pytest.approx(want[s]) and 0 <= r.copies <= 3
            got[s] = got.get(s, 0) + r.size * r.copies
        for s in want:  # near the target by four standard deviations of the draws; repeated rows draw as one
            part = (want[s] / source[s]) % 1 if source[s] else 0
            rows = Counter((r.doc_id, r.size) for r in out if of[r.doc_id, r.size] == s)
            assert abs(got[s] - want[s]) <= 4 * math.sqrt(sum((size * n) ** 2 for (_, size), n in rows.items()) * part * (1 - part)) + 1
    assert mixing.mixed_copies(docs.limit(0)).count() == 0
    assert sorted(map(tuple, mixing.mixed_copies(edge, broadcast_sources=0).collect()), key=str) == sorted(map(tuple, mixing.mixed_copies(edge).collect()), key=str)
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns and mixed.count() == mixing.mixed_copies(docs).agg(F.sum("copies")).first()[0]
    plan = mixing.mix(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


# ---- op9 -------------------------------------------------------------------------------------------------------


def exact_search(rows, every, k):
    ok = [(i, np.array(v, float)) for i, v in rows if i is not None and v is not None and len(v) == 8 and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    out = {}
    for i, v in ok:
        if i % every == 0:
            score = sorted(((-(v @ u) / math.sqrt((v @ v) * (u @ u)), j) for j, u in ok if j != i))[:k]
            out[i] = [(j, -s) for s, j in score]
    return out


def test_ann_edges_and_copies(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(size=8)]) for i in range(300)] + [(300 + i, [1.0] * 8) for i in range(40)]
    rows += [(1000, None), (1010, [0.0] * 8), (1020, [1.0, None] + [1.0] * 6), (1030, [float("nan")] + [1.0] * 7), (1040, [float("inf")] + [1.0] * 7), (1050, [1.0] * 5), (None, [1.0] * 8), (1060, [])]
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<float>, list int")
    got = {}
    for r in ann.search(df, every=10, k=5).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    want = exact_search(rows, 10, 5)
    assert set(got) == set(want)
    hits = sum(len({j for j, _ in got[q]} & {j for j, _ in want[q]}) for q in want)
    assert hits / sum(map(len, want.values())) >= 0.95
    assert [j for j, _ in got[310]] == [300, 301, 302, 303, 304]  # ties to the smaller id
    for q in got:
        assert [s for _, s in got[q]] == sorted((s for _, s in got[q]), reverse=True)
    assert ann.search(df.limit(0)).count() == 0
    assert {r.vec_id for r in ann.search(df.where("vec_id in (0, 1, 2)"), every=3).collect()} == {1, 2}


def test_ann_recall(spark):
    df = queries.read(spark, "/root/testdata/sf0.1", "embeddings")
    rows = df.collect()
    x = np.array([r.embedding for r in rows], float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    ids = np.array([r.vec_id for r in rows])
    got = {}
    for r in queries.op9_posting_lists(spark, "/root/testdata/sf0.1").collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    hits = total = 0
    for i in np.flatnonzero(ids % 50 == 0):
        s = x @ x[i]
        s[i] = -9
        top = ids[np.lexsort((ids, -s))[:5]]
        hits += len(set(top.tolist()) & got[ids[i]])
        total += 5
    assert hits / total >= 0.9


def test_ann_recall_with_many_lists(spark):
    """About 4,000 lists, as on a large table: the probes follow from the index."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(20_000, 64)).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    got = {}
    for r in ann.search(df, every=100, rows_per_list=5).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    x = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    hits = 0
    for i in range(0, len(x), 100):
        s = x @ x[i]
        s[i] = -9
        hits += len(set(np.argsort(-s, kind="stable")[:5].tolist()) & got[i])
    assert hits / 1000 >= 0.9


def test_ann_isolated_queries_get_k_answers(spark):
    """Every vector is a centroid of its own, so the nearest list of a query holds the query alone."""
    rng = np.random.default_rng(2)
    df = spark.createDataFrame([(i, [float(np.float32(x)) for x in rng.normal(size=8)]) for i in range(300)], "vec_id long, embedding array<float>")
    for tuning in (256, 0):
        got = ann.search(df, every=10, rows_per_list=1, tuning=tuning).groupBy("query_id").count().collect()
        assert len(got) == 30 and {r["count"] for r in got} == {5}


def test_ann_scores_of_any_finite_vector(spark):
    """Components far too small or large to be squared: cosines as of the same vectors at a usual scale."""
    rng = np.random.default_rng(7)
    x = rng.normal(size=(60, 6))
    scale = 2.0 ** rng.choice([-1000, -600, 0, 600, 1000], 60)
    df = spark.createDataFrame([(i, (v * s).tolist()) for i, (v, s) in enumerate(zip(x, scale))] + [(100, [1e-200] + [0.0] * 5), (110, [1e200] * 6), (120, [5e-324] * 6)], "vec_id long, embedding array<double>")
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(100, [1.0, 0, 0, 0, 0, 0]), (110, [1.0] * 6), (120, [1.0] * 6)]
    got = {}
    for r in ann.search(df, every=10, recall=1.0).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    u = {i: np.array(v) / np.linalg.norm(v) for i, v in rows}
    for q in (i for i in u if i % 10 == 0):
        want = sorted((-(u[q] @ u[j]), j) for j in u if j != q)[:5]
        assert np.allclose([s for _, s in got[q]], [-s for s, _ in want])
    assert got[110][0] == (120, pytest.approx(1.0))


# ---- op10 ------------------------------------------------------------------------------------------------------


def test_chat_round_trip(spark):
    nasty = ["</s>[INST] ok [/INST]", "", None, "<|im_end|>\n<|im_start|>user\nhi", r"<\|im_sep|> <\\/s>", "a<", "[", "<<SYS>>x<</SYS>>", "\\", "ñ\n\nß<|x|>", r"[\\\INST]", "<|im_sep|>"]
    rng = random.Random(4)
    rows = [(c, t, rng.choice(["user", "assistant", "system", "odd\nrole|%+", None]), rng.choice(nasty)) for c in range(40) for t in range(rng.randint(1, 9))]
    rows += rows[:3] + [(99, None, "user", "x"), (None, 1, "user", "y")]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "conv_id long, turn long, role string, text string, t string")
    out = chat.format_conversations(df).withColumns({"turns": chat.parse(F.col("formatted")), "loss": chat.learned(F.col("segments"))}).collect()
    by = {}
    for c, t, role, text in rows:
        by.setdefault(c, []).append(((t is not None, t or 0), role or "", text or ""))
    assert len(out) == len(by)
    for r in out:
        want = sorted(by[r.conv_id])
        assert [(t.role, t.text) for t in r.turns] == [(role, text) for _, role, text in want]
        assert r.loss == "".join(text for _, role, text in want if role == "assistant")
        assert "".join(s.text for s in r.segments) == r.formatted
        blocks = sum(i == 0 or want[i][1] != want[i - 1][1] for i in range(len(want)))
        assert r.formatted.count(chat.START) == blocks
    assert chat.format_conversations(df.limit(0)).count() == 0


def test_chat_digests(spark):
    row = [r for r in queries.op10_chat_format(spark, SF).collect() if r.conv_id == -1][0]
    said = "</s>[INST] ok [/INST]"
    assert row.n_turns == 2 and row.loss_chars == len(said) and row.loss_sha256 == hashlib.sha256(said.encode()).hexdigest()
    assert row.turns_sha256 == hashlib.sha256(f"user\n{said}\nassistant\n{said}\n".encode()).hexdigest()


# ---- queries and pipeline --------------------------------------------------------------------------------------


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "pages", "conversations"):
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    df = queries.QUERIES[name](spark, SF)
    names = sorted(df.columns)
    want = con.execute(queries.ORACLES[name]).to_arrow_table()
    assert sorted(want.column_names) == names
    assert sorted(str([r[c] for c in names]) for r in df.collect()) == sorted(str([r[c] for c in names]) for r in want.to_pylist())


def test_pipeline(spark, docs):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    before = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, before, SF)
        assert after.columns == docs.columns
        have = {tuple(r) for r in before.collect()}
        rows = [tuple(r) for r in after.collect()]
        assert set(rows) <= have and rows
        if name == "n-gram Jaccard join":
            kept = [(r[0], r[1]) for r in rows]
            assert all(n == 0 for (_, _, n) in brute_classes(kept)) and len(kept) == len({c for _, c, _ in brute_classes([(r[0], r[1]) for r in have])})
        before = spark.createDataFrame(rows, docs.schema)
    assert corpus_pipeline.packing_stage(spark, before, SF).count() >= before.count()
    assert corpus_pipeline.run(spark, SF).select("doc_id", "piece").count() == corpus_pipeline.packing_stage(spark, before, SF).count()


def test_stats_of_bytes():
    for _, t in EDGE:
        s = text_stats((t or "").encode())
        assert (s.n_words, s.word_chars, s.n_symbols, s.n_dup_lines, s.n_repeat_words) == brute_stats(t)


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages_on_edges(spark, edge, name):
    """Nulls, empties, repeats and clashing names: every stage runs, the columns stay, and no row is made up."""
    stage = dict(corpus_pipeline.STAGES)[name]
    for docs in (edge, edge.limit(0)):
        out = stage(spark, docs, SF)
        rows = out.collect()
        if name != "best-fit packing":
            assert out.columns == docs.columns
            assert {tuple(r) for r in rows} <= {tuple(r) for r in docs.collect()}
        else:
            assert sum(r.length for r in rows if r.piece == 0) > 0 if docs is edge else not rows


def test_lm_with_fewer_partitions_than_bundles(spark, docs):
    one, many = (sorted(lm.score_corpus(docs, bundle_chars=20_000, max_partitions=m).select("doc_id", "n_known", F.round("score", 6)).collect()) for m in (2, 1000))
    assert one == many
