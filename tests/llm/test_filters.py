"""Language profiles, toxicity and near duplicates against brute force and held-out labels."""

import base64
import bisect
import math
import random
from collections import Counter

import numpy as np
import pytest
from edges import documents, edge_frame, edge_rows, empty_frame

from kerbside.llm import common, langid, minhash, toxicity
from kerbside.llm.common import checksum, components
from kerbside.llm.queries import QUERIES

SF_001, SF_01 = "/root/testdata/sf0.01", "/root/testdata/sf0.1"


# -- language ----------------------------------------------------------------------------------------

def plain_grams(text):
    line = " " + "".join(c if c.isalpha() else " " for c in text.lower()) + " "
    line = " " + " ".join(line.split()) + " "
    if line.strip() == "":
        return Counter()
    return Counter([*line.replace(" ", ""), *(line[i:i + 2] for i in range(len(line) - 1)),
                    *(line[i:i + 3] for i in range(len(line) - 2))])


def code(gram):
    found = 0
    for c in gram:
        found = found << 21 | ord(c)
    return found


def places(counts):
    return {g: k for k, g in enumerate(sorted(counts, key=lambda g: (-counts[g], code(g)))[:langid.PROFILE])}


def test_language_as_brute_force(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    counts = {}
    for r in rows:
        if checksum(r.doc_id) % 3 != 1 and r.lang:
            counts.setdefault(r.lang, Counter()).update(plain_grams(r.text or ""))
    profiles = {lang: places(c) for lang, c in counts.items()}
    found = {r.doc_id: r for r in QUERIES["op7_language"](spark, sf_dir).collect()}
    assert len(found) == len(rows)
    for r in rows:
        own = places(plain_grams(r.text or ""))
        most = langid.PROFILE
        apart = {lang: sum(min(most, abs(p.get(g, 10 ** 9) - k)) if g in p else most for g, k in own.items())
                 for lang, p in profiles.items()}
        lang = min(sorted(apart), key=apart.get) if own else "und"
        score = 1 - apart[lang] / (most * len(own)) if own else 0.0
        assert (found[r.doc_id].lang_pred, found[r.doc_id].score) == (lang, pytest.approx(score))
        assert found[r.doc_id].held_out == (checksum(r.doc_id) % 3 == 1)


def test_language_of_held_out(spark):
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF_001}/documents.parquet").collect()}
    rows = [r for r in QUERIES["op7_language"](spark, SF_001).collect() if r.held_out]
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in rows]) > 0.98


def test_language_edges(spark):
    docs = edge_frame(spark)
    profiles = langid.learn(docs)
    rows = langid.identify(docs, profiles).collect()
    assert len(rows) == len(edge_rows())
    assert all((r.lang_pred == "und") == (r.score == 0 and r.lang_pred == "und") for r in rows)
    assert {r.doc_id for r in rows if r.lang_pred == "und"} == {0, 1, 2, 3, 7, None}
    kept = langid.keep_known(docs, profiles, langid.bounds(docs, profiles))
    assert kept.schema == docs.schema and 4 in {r.doc_id for r in kept.collect()}
    assert langid.identify(docs, langid.learn(empty_frame(spark))).filter("lang_pred <> 'und'").count() == 0
    assert langid.identify(empty_frame(spark), profiles).count() == 0


# -- toxicity ----------------------------------------------------------------------------------------


JUNK = {
    "letters": lambda pick: "".join(pick.choices("abcdefghijklmnopqrstuvwxyz ", k=1500)),
    "base64": lambda pick: base64.b64encode(pick.randbytes(1200)).decode(),
    "Polish": lambda pick: " ".join(pick.choices("wszyscy ludzie rodzą się wolni i równi pod względem swej godności oraz swych praw są "
                                                 "obdarzeni rozumem sumieniem powinni postępować wobec innych w duchu braterstwa".split(), k=120)),
    "no letter": lambda pick: "1234 -- 56",
    "Greek": lambda pick: "όλοι οι άνθρωποι γεννιούνται ελεύθεροι και ίσοι στην αξιοπρέπεια " * 3,
}


@pytest.mark.parametrize("folder", [SF_001, SF_01])
def test_language_stage_drops_junk_and_keeps_texts(spark, folder):
    import corpus_pipeline
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    pick = random.Random(2)
    junk = [(10 ** 9 + k, make(pick), None, "junk", 1) for k, make in enumerate(f for f in JUNK.values() for _ in range(5))]
    kept = corpus_pipeline.language(spark, docs.unionByName(spark.createDataFrame(junk, docs.schema)), folder)
    left = {r.doc_id for r in kept.select("doc_id").collect()}
    assert not left & {r[0] for r in junk}
    assert left == {r.doc_id for r in docs.filter("text rlike '[A-Za-z]'").collect()}


def test_bounds_as_plain_count(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    profiles = langid.learn(docs)
    own = {}
    for r in docs.collect():
        lang, score = profiles.predict(r.text or "")
        if lang == r.lang:
            own.setdefault(lang, []).append(int(score * langid.BINS))
    expected = {lang: langid.LEAST * sorted(bins)[-(-len(bins) // 100) - 1] / langid.BINS for lang, bins in own.items()}
    assert langid.bounds(docs, profiles) == pytest.approx(expected)


def test_more_languages_than_profiles(spark, monkeypatch):
    """Rare values of lang get no profile; nothing fails."""
    monkeypatch.setattr(langid, "LANGUAGES", 3)
    rows = [(k, f"word{chr(97 + k % 26)} text", f"l{k % 7}" if k < 70 else "l0") for k in range(90)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    profiles = langid.learn(docs)
    assert profiles.names == ["l0", "l1", "l2"]
    assert langid.identify(docs, profiles).count() == 90


def test_toxicity_of_held_out(spark):
    toxic = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF_01}/labels.parquet").collect()}
    rows = QUERIES["op5_toxicity"](spark, SF_01).collect()
    assert len(rows) == spark.read.parquet(f"{SF_01}/documents.parquet").count()
    assert all(r.held_out == (checksum(r.doc_id) % 5 == 0) and 0 <= r.score <= 1 for r in rows)
    bad = [r.score for r in rows if r.held_out and toxic.get(r.doc_id) == 1]
    good = sorted(r.score for r in rows if r.held_out and toxic.get(r.doc_id) == 0)
    assert sum(bisect.bisect(good, s) for s in bad) / len(bad) / len(good) > 0.99
    assert np.mean(np.array(bad) >= 0.5) > 0.8 and np.mean(np.array(good) >= 0.5) < 0.02


def test_risk_is_not_negative():
    """With few rows and many features, plain unbiased risk runs below zero; here unseen positives still score high."""
    pick = random.Random(1)
    rows = lambda n, toxic: [np.unique([*pick.choices(range(100, 4000), k=60), *([5] if toxic else [])])
                             for _ in range(n)]
    model = toxicity.fit(rows(60, True), rows(540, False) + rows(60, True), 0.1)
    score = lambda r: sum(model.weights.get(int(f), 0) for f in r) + model.bias
    assert min(map(score, rows(100, True))) > 0
    assert np.mean([score(r) > 0 for r in rows(400, False)]) < 0.05


def slow_fit(positive, unlabelled, prior):
    """The same training by plain loops: slopes by finite differences of the risk, features told apart by a z test."""
    rows = positive + unlabelled
    used = []
    for f in sorted({int(f) for r in rows for f in r}):
        a, b = (sum(f in r for r in part) for part in (positive, unlabelled))
        share = (a + b) / len(rows)
        error = math.sqrt(share * (1 - share) * (1 / len(positive) + 1 / len(unlabelled)))
        if error > 0 and abs(a / len(positive) - b / len(unlabelled)) >= toxicity.LEAST_Z * error:
            used.append(f)
    has = [[float(f in r) for f in used] + [1.0] for r in rows]

    def risks(w):
        margin = [sum(x * y for x, y in zip(h, w)) for h in has]
        low, high = [math.log1p(math.exp(-f)) for f in margin], [math.log1p(math.exp(f)) for f in margin]
        n = len(positive)
        own = prior * sum(low[:n]) / n
        negative = sum(high[n:]) / len(unlabelled) - prior * sum(high[:n]) / n
        return own, negative, toxicity.DECAY / 2 * sum(x * x for x in w[:-1])

    w = [0.0] * len(used) + [math.log(prior / (1 - prior))]
    mean, square, clipped = [0.0] * len(w), [0.0] * len(w), 0
    for step in range(1, toxicity.STEPS + 1):
        below = risks(w)[1] < 0
        clipped += below

        def goal(at):
            own, negative, decay = risks(at)
            return (-negative if below else own + negative) + decay
        for k in range(len(w)):
            up, down = list(w), list(w)
            up[k] += 1e-5
            down[k] -= 1e-5
            slope = (goal(up) - goal(down)) / 2e-5
            mean[k] = 0.9 * mean[k] + 0.1 * slope
            square[k] = 0.999 * square[k] + 0.001 * slope ** 2
        w = [x - toxicity.RATE * (m / (1 - 0.9 ** step)) / (math.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
             for x, m, v in zip(w, mean, square)]
    return dict(zip(used, w[:-1])), w[-1], clipped


@pytest.mark.parametrize("seed", [1, 2])
def test_training_as_plain_loop(seed, monkeypatch):
    """Weights come out as by a slow training that shares no code, with the risk above zero and cut off at it."""
    monkeypatch.setattr(toxicity, "STEPS", 60)
    monkeypatch.setattr(toxicity, "LEAST_Z", 0.8)
    pick = random.Random(seed)
    rows = lambda n, chance: [np.unique([f for f in range(10, 18) if pick.random() < chance] +  # noqa: E731
                                        [pick.randrange(20, 24)]) for _ in range(n)]
    positive, unlabelled = rows(12, 0.7), rows(30, 0.25)
    prior = 0.3 if seed == 1 else 0.7
    weights, bias, clipped = slow_fit([set(r.tolist()) for r in positive], [set(r.tolist()) for r in unlabelled], prior)
    model = toxicity.fit(positive, unlabelled, prior)
    assert model.weights == pytest.approx(weights, abs=1e-4) and model.bias == pytest.approx(bias, abs=1e-4)
    assert len(weights) > 3 and clipped < toxicity.STEPS and (clipped > 0 or seed != 1)


def test_sample_with_repeated_ids(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "POSITIVES", 4)
    monkeypatch.setattr(toxicity, "UNLABELLED", 5)
    sizes = []
    monkeypatch.setattr(toxicity, "fit", lambda *a: sizes.append((len(a[0]), len(a[1]))))
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(60) for _ in range(10)], "doc_id long, text string")
    toxicity.learn(docs, spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, toxic int"))
    assert sizes == [(4, 5)]


def test_toxicity_edges(spark):
    docs = edge_frame(spark)
    labels = spark.createDataFrame([(4, 0, 1), (5, None, 0), (5, None, None), (None, 1, 1), (99, 1, 1)],
                                   "doc_id long, quality int, toxic int")
    for marks in (labels, labels.limit(0)):
        model = toxicity.learn(docs, marks)
        rows = toxicity.score(docs, model).collect()
        assert len(rows) == len(edge_rows()) and all(0 <= r.score <= 1 for r in rows)
        assert toxicity.keep_clean(docs, model).schema == docs.schema
    assert toxicity.score(docs, toxicity.learn(docs, labels.limit(0))).filter("score > 0").count() == 0
    assert toxicity.score(empty_frame(spark), toxicity.learn(empty_frame(spark), labels)).count() == 0


# -- near duplicates ---------------------------------------------------------------------------------

def shingle_set(text, width):
    words = text.encode().lower().split()
    return frozenset(zip(*(words[k:] for k in range(width)))) if len(words) >= width else frozenset([tuple(words)] if
                                                                                                    words else [])


def brute_force(texts, width, percent=80):
    sets = {i: shingle_set(text, width) for i, text in texts.items()}
    component = {i: i for i in sets}
    ids = sorted(sets)
    by_set = {}
    for i in ids:
        if sets[i]:
            by_set.setdefault(sets[i], i)
            component[i] = by_set[sets[i]]
    reps = sorted(by_set.values())
    for k, a in enumerate(reps):
        for b in reps[k + 1:]:
            common = len(sets[a] & sets[b])
            if 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common) and component[a] != component[b]:
                low, high = sorted((component[a], component[b]))
                component = {i: low if c == high else c for i, c in component.items()}
    return {i: (len(sets[i]), component[i], component[i] == i) for i in ids}


def as_rows(found):
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in found.collect()}


def test_near_duplicates_as_brute_force(spark, sf_dir):
    assert as_rows(QUERIES["op8_near_duplicates"](spark, sf_dir)) == brute_force(documents(spark, sf_dir), 4)


def test_families_around_the_threshold(spark, monkeypatch):
    """Copies with many edits: most pairs are close to the threshold, hubs do not reach all of them."""
    monkeypatch.setattr(minhash, "TILE", 16)
    pick = random.Random(5)
    word = lambda: "".join(pick.choices("abcdefgh", k=6))
    texts, shared = {}, [word() for _ in range(60)]
    for size, n in ((120, 70), (45, 40), (300, 30)):
        base = [word() for _ in range(size)]
        for _ in range(n):
            copy = list(base)
            for _ in range(pick.randint(0, size // 12)):
                copy[pick.randrange(size)] = word()
            texts[len(texts)] = " ".join(copy)
            base = copy if pick.random() < 0.2 else base
    for _ in range(30):  # a passage that many different documents share
        texts[len(texts)] = " ".join([word() for _ in range(30)] + shared + [word() for _ in range(40)])
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    expected = brute_force(texts, 4)
    assert len({c for _, c, _ in expected.values()}) > 40
    assert as_rows(minhash.near_duplicates(docs, 4)) == expected


def test_near_duplicate_edges(spark):
    docs = edge_frame(spark)
    rows = minhash.near_duplicates(docs).collect()
    assert len(rows) == len(edge_rows())
    found = {r.doc_id: r for r in rows}
    assert found[6].component_id == 5 and not found[6].kept and found[5].kept
    assert found[1].n_shingles == 0 and found[1].kept and found[0].kept
    assert all(r.component_id is None and r.kept for r in rows if r.doc_id is None)
    kept = minhash.keep_one(docs)
    assert kept.schema == docs.schema
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == [0, 1, 2, 3, 4, 4, 5, 7, 8, 9, 10, 11,
                                                                              11, 12]
    assert minhash.near_duplicates(empty_frame(spark)).count() == 0


@pytest.mark.parametrize("heavy", [1, 1000])
def test_an_id_with_several_texts(spark, monkeypatch, heavy):
    """Rows are texts, but links are between ids: one id with several texts is in the component of each of them."""
    monkeypatch.setattr(common, "HEAVY", heavy)
    pick = random.Random(9)
    word = lambda: "".join(pick.choices("abcdefgh", k=6))
    rows = []
    for family in range(40):
        base = [word() for _ in range(60)]
        for _ in range(4):
            copy = list(base)
            for _ in range(pick.randint(0, 3)):
                copy[pick.randrange(60)] = word()
            rows.append((pick.randrange(60), " ".join(copy)))
    rows += [(1000, ""), (rows[0][0], ""), (None, rows[0][1]), (3000, "a b c"), (3000, "d e f"), (2000, "d e f")] + rows[:3]
    sets = [(i, shingle_set(text, 4)) for i, text in rows]
    component = {i: i for i, _ in rows if i is not None}
    for a, x in sets:
        for b, y in sets:
            if a is not None and b is not None and x and y and 100 * len(x & y) >= 80 * len(x | y):
                low, high = sorted((component[a], component[b]))
                component = {i: low if c == high else c for i, c in component.items()}
    expected = sorted(((i, len(x), None if i is None else component[i] if x else i,
                        i is None or (component[i] if x else i) == i) for i, x in sets), key=str)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert sorted(map(tuple, minhash.near_duplicates(docs, 4).collect()), key=str) == expected
    assert len(set(component.values())) > 3


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(10, 60)] + [(100, i) for i in range(101, 140)] + [(7, 139), (5, 5), (60, 59)]
    found = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long"), "t").collect()}
    assert found == {**{i: 10 for i in range(10, 61)}, **{i: 7 for i in [7, *range(100, 140)]}}
    assert components(spark.createDataFrame([], "a long, b long"), "t").count() == 0


# -- pipeline ----------------------------------------------------------------------------------------

def test_pipeline_stages(spark, sf_dir):
    import corpus_pipeline
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, before, sf_dir)
        assert after.schema == docs.schema, name
        assert after.count() <= before.count() and after.count() > 0.5 * docs.count()
        before = after
    left = {r.doc_id: r.text for r in before.collect()}
    expected = brute_force(left, 5)
    assert all(kept for _, _, kept in expected.values())
    rows = corpus_pipeline.run(spark, sf_dir).collect()
    assert {r.doc_id for r in rows} == set(left)
    for stage in corpus_pipeline.STAGES:
        assert stage[1](spark, docs.limit(0), sf_dir).count() == 0
