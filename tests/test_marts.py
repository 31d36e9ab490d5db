"""Diversity, ranking and overlap against brute force."""

import itertools
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from chronomart.operators import membership, overlap

MART = "id_frente int, nome_frente string, iddeputado int, nome string, partido string, uf string"


def mart_of(spark, pairs, party=lambda m: "P"):
    return spark.createDataFrame([(g, f"G{g}", m, f"M{m}", party(m), "UF") for g, m in pairs], MART)


def brute_overlap(pairs, min_common, k):
    members = {}
    for g, m in set(pairs):
        members.setdefault(g, set()).add(m)
    edges = [
        (a, f"G{a}", b, f"G{b}", len(members[a] & members[b]))
        for a, b in itertools.combinations(sorted(members), 2)
        if len(members[a] & members[b]) >= min_common
    ]
    edges.sort(key=lambda e: (-e[4], e[0], e[2]))
    return edges[:k]


def random_pairs(seed, hot):
    """Groups of uneven size; ``hot`` members belong to nearly every group, so each holds a large
    share of all rows."""
    rng = random.Random(seed)
    pairs = []
    for g in range(40):
        pairs += [(g, rng.randrange(100, 130)) for _ in range(rng.randrange(1, 12))]
        pairs += [(g, h) for h in range(hot) if rng.random() < 0.9]
    return pairs + pairs[:25]  # repeated rows must not count twice


@pytest.mark.parametrize("hot", [0, 3, 6])
@pytest.mark.parametrize("min_common,block_rows", [(5, 2000), (5, 4), (2, 7), (1, 3)])
def test_overlap(spark, hot, min_common, block_rows):
    pairs = random_pairs(hot, hot)
    found = overlap.overlap_edges(
        mart_of(spark, pairs), min_common=min_common, k=None, block_rows=block_rows
    )
    expected = brute_overlap(pairs, min_common, None)
    assert [tuple(r) for r in found.collect()] == expected and expected


@pytest.mark.parametrize("hot,k,block_rows", [(4, 10, 2000), (6, 3, 4), (0, 50, 2000), (6, 900, 5)])
def test_overlap_top_k(spark, hot, k, block_rows):
    pairs = random_pairs(5, hot)
    found = overlap.overlap_edges(mart_of(spark, pairs), k=k, block_rows=block_rows)
    assert [tuple(r) for r in found.collect()] == brute_overlap(pairs, 5, k)


def test_overlap_of_large_groups(spark):
    """The least weight of interest is in the hundreds, and so are the members set aside."""
    rng = random.Random(3)
    pairs = [(g, m) for g in range(14) for m in range(400) if rng.random() < 0.93 - g / 50]
    pairs += [(g, rng.randrange(1000)) for g in range(20, 60) for _ in range(30)]
    for k in (1, 6, 40):
        mart = mart_of(spark, pairs)
        found = overlap.overlap_edges(mart, k=k)
        expected = brute_overlap(pairs, 5, k)
        assert [tuple(r) for r in found.collect()] == expected and expected[0][4] > 248


def test_bound_is_reached_by_k_edges(spark):
    pairs = random_pairs(5, 6)
    df = spark.createDataFrame(sorted({(m, g) for g, m in pairs}), "_m int, _g int")
    weights = [e[4] for e in brute_overlap(pairs, 0, None)]
    for k in (1, 5, 50):
        assert 0 < overlap.weight_of_kth_edge(df, k) <= weights[k - 1]
    assert overlap.weight_of_kth_edge(df, 5000) == 0
    assert overlap.weight_of_kth_edge(df.where("_g = 1"), 5) == 0


def test_overlap_when_nothing_qualifies(spark):
    assert overlap.overlap_edges(mart_of(spark, [(1, 1), (2, 1)])).isEmpty()


def test_diversity(spark):
    pairs = [(1, m) for m in range(4)] + [(2, m) for m in range(4)] + [(3, 9)]
    mart = mart_of(spark, pairs, party=lambda m: "AB"[m % 2] if m < 9 else None)
    mart = mart.where("id_frente <> 2 OR partido = 'A'")
    found = {r.id_frente: (r.herfindahl_index, r.diversidade) for r in membership.diversity_index(mart).collect()}
    assert found == {1: (0.5, 0.5), 2: (1.0, 0.0), 3: (1.0, 0.0)}


def test_diversity_is_the_sum_of_squared_shares(spark):
    rng = random.Random(1)
    pairs = [(g, m) for g in range(12) for m in rng.sample(range(60), rng.randrange(3, 50))]
    mart = mart_of(spark, pairs, party=lambda m: "ABCDEFG"[m % 7])
    found = {r.id_frente: r.herfindahl_index for r in membership.diversity_index(mart, k=None).collect()}
    for g in range(12):
        counts = Counter("ABCDEFG"[m % 7] for h, m in pairs if h == g)
        total = sum(counts.values())
        assert found[g] == pytest.approx(sum((n / total) ** 2 for n in counts.values()))


def test_marts_take_current_rows_only(spark):
    def with_state(df):
        return df.withColumn("is_current", F.col("state") == 1).drop("state")

    terms = spark.createDataFrame([(56, "2019-02-01"), (57, "2023-02-01")], "id int, dataInicio string")
    terms = terms.withColumn("dataInicio", F.to_date("dataInicio"))
    groups = with_state(spark.createDataFrame(
        [(1, "old name", 57, 0), (1, "name", 57, 1), (2, "former", 56, 1)],
        "id int, titulo string, idLegislatura int, state int",
    )).withColumn("datacriacao", F.lit("2023-03-01").cast("date"))
    links = with_state(spark.createDataFrame(
        [(1, 7, "Ana", "SP", 0), (1, 7, "Ana", "RJ", 1), (2, 7, "Ana", "RJ", 1)],
        "id int, iddeputado int, nome string, siglaUf string, state int",
    ))
    people = with_state(spark.createDataFrame([(7, "X", 0), (7, "Y", 1)], "id int, siglaPartido string, state int"))
    found = membership.membership_mart(terms, groups, links, people).collect()
    assert [(r.id_frente, r.nome_frente, r.partido, r.uf) for r in found] == [(1, "name", "Y", "RJ")]
    counts = membership.groups_per_term(groups).collect()
    assert [tuple(r) for r in counts] == [(57, 1), (56, 1)]
    assert membership.latest_term(groups, terms.limit(0)).isEmpty()
