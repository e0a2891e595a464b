"""Links of crowded clusters against brute force over sets of word tuples."""

import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from tickmart.llm import ngram_join
from tickmart.llm.ngram_join import ngram_links


def word_sets(text):
    words = text.lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def expected(rows):
    sets = {doc: word_sets(text) for doc, text in rows}
    ids = sorted(sets)
    links, label = dict.fromkeys(ids, 0), {i: i for i in ids}

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for n, i in enumerate(ids):
        for j in ids[n + 1 :]:
            both = len(sets[i] & sets[j])
            if Fraction(both, len(sets[i]) + len(sets[j]) - both) >= Fraction(4, 5):
                links[i] += 1
                links[j] += 1
                a, b = sorted((root(i), root(j)))
                label[b] = a
    return sorted((i, root(i), links[i]) for i in ids)


def variants(rng, n, words, most):
    base = [f"w{rng.randrange(10**6)}" for _ in range(words)]
    for _ in range(n):
        some = list(base)
        for _ in range(rng.randint(0, most)):
            some[rng.randrange(words)] = f"x{rng.randrange(10**6)}"
        yield " ".join(some)


@pytest.mark.parametrize("most", [1, 3, 6])
def test_links_of_crowded_clusters(spark, monkeypatch, most):
    monkeypatch.setattr(ngram_join, "BLOCK", 16)
    rng = random.Random(most)
    texts = [*variants(rng, 90, 120, most), *variants(rng, 10, 80, 2), *variants(rng, 40, 60, 1)]
    texts += rng.choices(texts, k=25)
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    found = ngram_links(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert sorted(map(tuple, found.select("doc_id", "class_id", "n_links").collect())) == expected(rows)


def test_a_chain_without_a_center(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK", 4)
    words = [f"w{i}" for i in range(400)]
    rows = [(i, " ".join(words[4 * i : 4 * i + 100])) for i in range(40)]
    found = ngram_links(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert sorted(map(tuple, found.select("doc_id", "class_id", "n_links").collect())) == expected(rows)


def test_near_copies_are_proved_by_their_center_not_paired(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK", 16)
    dealt = []
    keep = lambda *a, f=ngram_join.around_centers: (dealt.append(f(*a)), dealt[-1])[1]
    monkeypatch.setattr(ngram_join, "around_centers", keep)
    rows = list(enumerate(variants(random.Random(4), 200, 150, 1)))
    found = ngram_links(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert found.where(F.col("n_links") != 199).count() == 0 and found.select("class_id").distinct().count() == 1
    assert dealt[0][0].count() == 0
