"""What registered queries compute once."""

import os

import pytest

from strandlake.jobs import territory

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")
def test_contigs_and_regions_are_summed_in_one_sweep(spark, monkeypatch):
    calls, table = [], territory.te.table
    monkeypatch.setattr(territory.te, "table", lambda labels, *a: calls.append(1) or table(labels, *a))
    assert territory.QUERIES["te_additivity"](spark, SF).columns == ["chrom", "territory_metric", "region_bp", "contig_bp"]
    assert len(calls) == 1
