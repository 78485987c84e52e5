import random

import corpus_pipeline
import numpy as np
from tallyworks.llm import shingles, simhash
from tallyworks.llm.components import components

from .test_simhash import plain_components, plain_fp


def plain_shingles(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", lower) if w]
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def plain_near(a, b):
    a, b = plain_shingles(a), plain_shingles(b)
    return bool(a) and 5 * len(a & b) >= 4 * len(a | b)


def texts(rng, bases=12, copies=10):
    """Groups of copies with 0 to 3 changed words, some around the bound, a passage in most of them, and short texts."""
    vocabulary = [f"w{i}" for i in range(3000)]
    passage = rng.choices(vocabulary, k=12)
    out = ["", None, " \n", "One two", "one  TWO", "one two three", "a b c d e", "a b c d E\n", "a b c d f"]
    for _ in range(bases):
        base = rng.choices(vocabulary, k=rng.randrange(20, 160)) + passage
        for _ in range(copies):
            words = list(base)
            for _ in range(rng.randrange(4)):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            out.append(" ".join(words))
    return out


def test_links_equal_brute_force(spark):
    made = texts(random.Random(3))
    rows = list(enumerate(made)) + [(500, made[20]), (None, made[21])]
    fp = {t: plain_fp(t) for t in made}
    linked = [(fp[a], fp[b]) for i, a in enumerate(made) for b in made[:i] if plain_near(a, b)]
    assert sum(bin(a ^ b).count("1") > 2 for a, b in linked) > 50
    want = plain_components(sorted(set(fp.values())), linked)
    edges = shingles.near_links(spark.createDataFrame(rows, "doc_id long, text string"))
    got = {r.node % 2**64: r.component % 2**64 for r in components(edges).collect()}
    groups = lambda of: sorted(sorted(x for x in want if of(x) == c) for c in {of(x) for x in want})
    assert groups(lambda x: got.get(x, x)) == groups(want.get)
    assert shingles.near_links(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_filter_lets_all_near_pairs_pass():
    made = [t for t in texts(random.Random(4), 8, 60) if t]
    hashes = [shingles._hashes(t.encode()) for t in made]
    bits = np.stack([np.packbits((np.bincount(h & 1023, minlength=1024) & 1).astype(np.uint8)).view(np.uint64) for h in hashes])
    n = np.array([len(h) for h in hashes])
    want = {(i, j) for i in range(len(made)) for j in range(i + 1, len(made)) if plain_near(made[i], made[j])}
    passed = [np.stack(x, axis=1) for x in shingles._group_pairs(np.arange(len(made)), n, bits, False)]
    assert want <= {tuple(sorted(p)) for p in np.concatenate(passed).tolist()}
    forest = np.concatenate([np.stack(x, axis=1) for x in shingles._group_pairs(np.arange(len(made)), n, bits, True)]).tolist()
    assert len(forest) < len(made)
    all_of, of = (plain_components(range(len(made)), pairs) for pairs in (np.concatenate(passed).tolist(), forest))
    assert all_of == of


def test_stage_drops_near_copies_beyond_two_bits(spark):
    words = [f"word{i}" for i in range(60)]
    rows = [(1, " ".join(words)), (2, " ".join(["quite", "other", "words", *words[3:]])), (3, " ".join([*words[:55], "some", "quite", "new", "last", "thing"])), (4, " ".join(words[30:]))]
    assert min(bin(plain_fp(rows[0][1]) ^ plain_fp(t)).count("1") for _, t in rows[1:3]) > 2
    docs = spark.createDataFrame([(i, t, "en", "a", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    assert sorted(r.doc_id for r in corpus_pipeline.drop_near_duplicates(spark, docs, "").collect()) == [1, 4]
    assert {r.doc_id: r.component_id for r in simhash.near_duplicates(docs).collect()} == {1: 1, 2: 2, 3: 3, 4: 4}


def test_stage_tells_texts_of_one_id_apart(spark):
    a, b = " ".join(f"word{i}" for i in range(40)), " ".join(f"other{i}" for i in range(40))
    rows = [(1, a), (7, a), (7, b), (8, b), (9, a + " end"), (9, a), (None, a), (None, b), (4, ""), (4, None)]
    docs = spark.createDataFrame([(i, t, "en", "a", 0) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = corpus_pipeline.drop_near_duplicates(spark, docs, "").collect()
    assert sorted((r.doc_id or 0, r.text or "") for r in got) == sorted([(1, a), (7, b), (0, a), (0, b), (4, ""), (4, "")])


def test_long_texts(spark):
    """Texts that fill the narrow buckets, near and not, all sharing a passage."""
    rng = random.Random(4)
    shared = [f"s{i}" for i in range(300)]
    texts = []
    for k in range(12):
        words = shared + [f"w{rng.randrange(10**6)}" for _ in range(3000)]
        texts.append(" ".join(words))
        if k % 3 == 0:
            for share in (0.005, 0.02, 0.05):
                other = [w if rng.random() > share else "x" + w for w in words]
                texts.append(" ".join(other))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    nodes = {shingles._signed(simhash.fingerprint(t.encode())): i for i, t in enumerate(texts)}
    sets = [shingles.shingles(t.encode()) for t in texts]
    want = {frozenset((i, j)) for i in range(len(texts)) for j in range(i) if shingles.near(sets[i], sets[j])}
    got = {frozenset((nodes[r.a], nodes[r.b])) for r in shingles.near_links(df).collect()}
    assert want and got <= want and plain(got) == plain(want)


def plain(pairs):
    """The groups that the pairs join."""
    groups = []
    for pair in pairs:
        met = [g for g in groups if g & pair]
        groups = [g for g in groups if not g & pair] + [set(pair).union(*met)]
    return {frozenset(g) for g in groups}
