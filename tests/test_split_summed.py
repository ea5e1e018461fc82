"""Grouped pieces that are read off a cell's array, against pieces that are grouped as rows."""

import numpy as np
import pytest

from spanloom import catalog
from spanloom.operators import intervals as I


@pytest.mark.parametrize("stranded,cell", [(False, None), (True, 7), (False, 1000)])
def test_summed_pieces_equal_grouped_pieces(spark, bed, stranded, cell):
    r = np.random.default_rng(11)
    rows = [("ab"[i % 2], int(s), int(s + n), f"f{i}", None if i % 9 == 0 else float(i), "+-"[i % 3 % 2]) for i, (s, n) in enumerate(zip(r.integers(0, 900, 150), r.integers(1, 60, 150)))]
    rows += [("a", 2000, 2010, "alone", None, "+"), ("b", 5, 400, "0", 1.0, "-"), ("b", 5, 400, "0", 1.0, "-")]
    f = bed(rows)
    plain = lambda d: sorted((x["chrom"], x["start"], x["end"], x["strand"], x["name"], x["score"]) for x in d.collect())
    assert plain(I.split_summed(f, stranded=stranded, cell=cell)) == plain(I.group(I.split(f, stranded=stranded, cells=True), "SUM", stranded=stranded))


def test_features_of_pieces_are_not_grouped_as_rows(spark):
    """A row for each piece and feature, grouped by piece, is spilled in proportion to the depth's square."""
    plan = catalog.QUERIES["split_grouped"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    grouped = [line for line in plan.splitlines() if "Aggregate" in line and "collect_list" in line]
    assert grouped and not any("name" in line and ", start" in line.split("],")[0] for line in grouped)
