"""Sides of joins that grow with the input are not broadcast, however few bytes their files are said to hold."""

import pytest
from pyspark.sql import functions as F

from clanweave.functions.ordered import rank_within
from clanweave.operators import abundance as B
from clanweave.operators import graph as G


def _broadcasts(df):
    return df._jdf.queryExecution().executedPlan().toString().count("BroadcastHashJoin")


@pytest.fixture
def small(spark):
    """Named rows of 0..5, whose size Spark knows to be small."""
    text = lambda p: F.concat(F.lit(p), (F.col("id") % 3).cast("string"))
    return lambda **columns: spark.range(6).select(*[(text(c) if isinstance(c, str) else c).alias(n) for n, c in columns.items()])


@pytest.fixture
def tables(small):
    long = F.col("id")
    return {
        "markers": small(marker="m", family="f", type="TM", marker_len=long),
        "hits": small(sample="s", marker="m", read_id="r", pid=long + 95.0, alen=long + 40, read_len=long + 100),
        "counts": small(sample="s", marker="m", family="f", norm=long * 1.0, hits=long, marker_len=long),
    }


def test_marker_joins_are_dealt_by_key(tables):
    for found in (B.valid_hits(tables["hits"], tables["markers"]), B.full_length_hits(tables["hits"], tables["markers"])):
        assert _broadcasts(found) == 0 and found.count() > 0


def test_families_and_samples_are_dealt_by_key(small, tables):
    fam = B.family_abundance(tables["counts"], tables["markers"])
    assert _broadcasts(fam) == 0 and fam.count() == 3
    over, types = small(marker="m", family="f").distinct(), small(family="f", type=F.lit("QM")).distinct()
    assert _broadcasts(B.bayes_adjust(tables["counts"], small(sample="s", family="f", median=F.col("id") * 1.0), over, types)) == 0
    assert _broadcasts(B.merge_samples(small(sample="s", family="f", value=F.col("id")), small(protein="f", cluster="c"))) == 0


def test_ranks_of_many_groups_are_dealt_by_key(small):
    assert _broadcasts(rank_within(small(g="g", v=F.col("id")), ["g"], ["v"], "r")) == 0


def test_cluster_joins_are_dealt_by_key(small):
    long = F.col("id")
    comp, meta = small(node="n", component="n"), small(node_id="n", member="n")
    number = small(component="n", seq_number=long, singleton_number=long, seq_count=long)
    notes = small(accession="n", SwissProt_Description="d")
    assert _broadcasts(G.swissprot_by_cluster(comp, number, notes, meta)) == 0
    assert _broadcasts(G.cluster_ids_by_source(comp, number, meta, small(accession="n", uniref50_seed="u", uniref90_seed="u"))) == 0
    assert _broadcasts(G.cluster_counts(comp, meta)) == 0
