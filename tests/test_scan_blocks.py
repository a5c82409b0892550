"""Levels end for blocks of one position too."""

from commitlens.operators.scan import fold_elements, scan_elements
from fixtures import rows


def test_blocks_of_one_position_end(spark):
    items = spark.createDataFrame([(1, i, i + 1) for i in range(3)], "seq_id long, pos long, e long")
    add = lambda x, y: x + y
    assert {(r.pos, r.before) for r in scan_elements(items, add, block=1).collect()} == {(0, None), (1, 1), (2, 3)}
    assert rows(fold_elements(items, add, block=1)) == [(1, 6)]
