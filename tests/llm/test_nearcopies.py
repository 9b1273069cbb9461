import random

import pyarrow as pa
import pytest

import corpus_pipeline as C
from tallyglass.llm import nearcopies as N
from tallyglass.llm import simhash

D = "/root/testdata/sf0.001"


def slow_set(text):
    words = [w for w in (text or "").encode().lower().split()]
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def slow_groups(texts):
    """The smallest index of the group of each text, by all pairs."""
    sets, root = [slow_set(t) for t in texts], list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if 5 * len(a & b) >= 4 * len(a | b):
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return [find(i) for i in range(len(texts))]


def edited(r, words, n):
    words = list(words)
    for _ in range(n):
        words[r.randrange(len(words))] = f"new{r.randrange(10**6)}"
    return words


def test_groups_are_those_of_all_pairs(spark):
    r = random.Random(3)
    texts = [None, "", " \n", "one two", "One TWO", "a b c d e", "a b c d e f"]
    for n in (30, 120, 400):
        for _ in range(4):
            words = [f"w{r.randrange(5000)}" for _ in range(n)]
            for _ in range(12):  # chains: the ends are less alike than neighbours
                texts.append(" ".join(words))
                words = edited(r, words, r.randint(0, n // 40 + 1))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {}
    for x in N.groups(docs).collect():
        found.setdefault(x.root, set()).add(x.doc_id)
    want = {}
    for i, g in enumerate(slow_groups(texts)):
        want.setdefault(g, set()).add(i)
    assert sorted(map(sorted, found.values())) == sorted(map(sorted, want.values())) and max(map(len, want.values())) > 5
    assert N.groups(docs.limit(0)).count() == 0


def test_stage_joins_near_copies_that_fingerprints_leave(spark):
    words = [f"word{i}" for i in range(150)]
    near = [*words[:60], "other", *words[61:100], "else", *words[101:]]
    far = edited(random.Random(1), words, 40)
    rows = [(7, " ".join(words), "en"), (8, " ".join(near), "en"), (9, " ".join(far), "en")]
    assert (simhash.fingerprint(rows[0][1]) ^ simhash.fingerprint(rows[1][1])).bit_count() > 3
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    stay = dict(C.STAGES)["near_duplicates"](spark, docs, D)
    assert stay.columns == docs.columns and {r.doc_id for r in stay.collect()} == {7, 9}


def test_stage_on_documents(spark):
    docs = spark.read.parquet(f"{D}/documents.parquet")
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    want = {rows[g][0] for g in slow_groups([t for _, t in rows])}
    assert {r.doc_id for r in dict(C.STAGES)["near_duplicates"](spark, docs, D).collect()} == want


@pytest.mark.parametrize("rare", [0, 2, 64])
def test_family_and_shared_passage(spark, monkeypatch, rare):
    """A family around one text, edited little or much, with and without that text, and texts that only quote one passage; pairs stay few."""
    r = random.Random(11)
    texts = []
    for with_source in (True, False):
        words = [f"f{with_source}{r.randrange(9000)}" for _ in range(100)]
        texts += [" ".join(words)] * with_source
        texts += [" ".join(edited(r, words, r.randint(1, 5))) for _ in range(120)]
        texts += [" ".join(words[: r.randrange(70, 99)]) for _ in range(15)]  # cut short: all their shingles are others' too
    passage = [f"p{i}" for i in range(60)]
    texts += [" ".join([*(f"q{r.randrange(10**6)}" for _ in range(r.randrange(25, 60))), *passage]) for _ in range(150)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    made, plain = [], N._left_pairs
    monkeypatch.setattr(N, "RARE", rare)
    monkeypatch.setattr(N, "_left_pairs", lambda *a: made.append(plain(*a)) or made[-1])
    found = {}
    for x in N.groups(docs).collect():
        found.setdefault(x.root, set()).add(x.doc_id)
    want = {}
    for i, g in enumerate(slow_groups(texts)):
        want.setdefault(g, set()).add(i)
    assert sorted(map(sorted, found.values())) == sorted(map(sorted, want.values()))
    assert rare < 64 or made[0].count() < 10 * len(texts)


def test_links_of_fingerprints_come_first_and_are_checked(spark, monkeypatch):
    """Ball hashing joins by itself, bands are not asked again for what it joined, and three bits without 0.8 join nothing."""
    r = random.Random(4)
    words = [f"w{r.randrange(9000)}" for _ in range(600)]
    edges = [words, [*words[:-1], "end"], ["start", *words[1:]]]
    tails = [["a", "b", "c"] * 300 + [f"{x}{i}" for i in range(12)] for x in "xy"]  # repeats weigh in fingerprints, not in sets
    texts = [" ".join(w) for w in [*edges, *tails, *edges[:1]]]
    apart = lambda i, j: (simhash.fingerprint(texts[i]) ^ simhash.fingerprint(texts[j])).bit_count()
    assert max(apart(0, 1), apart(0, 2)) <= 3 and apart(3, 4) <= 3 and slow_groups(texts) == [0, 0, 0, 3, 4, 0]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    stage = dict(C.STAGES)["near_duplicates"]

    compared, joined = [], N._joined
    with monkeypatch.context() as m:
        m.setattr(N, "_joined", lambda pairs, sets: compared.append(pairs.count()) or joined(pairs, sets))
        assert {x.doc_id for x in stage(spark, docs, D).collect()} == {0, 3, 4}
    assert compared[0] >= 2 and compared[1] == 0

    signed = N._signed

    def without_bands(batches):
        for b in signed(batches):
            yield b.set_column(b.schema.get_field_index("keys"), "keys", pa.array([[]] * b.num_rows, pa.list_(pa.int64())))

    monkeypatch.setattr(N, "_signed", without_bands)
    assert {x.doc_id for x in stage(spark, docs, D).collect()} == {0, 3, 4}
