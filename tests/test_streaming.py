"""Daily ingest stream: bars from several landed batches equal bars built in one go."""

import os
import tempfile

from pyspark.sql import functions as F

from barlab.sources import tables as T
from barlab.sources.bars import build_bars
from barlab.streaming.daily import merged_bars, start_bar_stream
from conftest import SF_SMALL


def test_stream_bars_equal_batch_bars(spark):
    root = tempfile.mkdtemp(prefix="barlab-stream-")
    landing, partials, ckpt = (os.path.join(root, d) for d in ("landing", "partials", "ckpt"))
    lines = T.priced_lines(spark, SF_SMALL).select("p_brand", "l_shipdate", "l_orderkey", "l_linenumber",
                                                    "price", "l_quantity")
    # two landed files: trades split by order key parity (arrival order does not matter)
    lines.filter(F.col("l_orderkey") % 2 == 0).write.parquet(os.path.join(landing, "a"))
    lines.filter(F.col("l_orderkey") % 2 == 1).write.parquet(os.path.join(landing, "b"))
    schema = lines.schema
    q = start_bar_stream(spark, os.path.join(landing, "*"), schema, partials, ckpt, key="p_brand", ts="l_shipdate",
                         price="price", qty="l_quantity", grain="week", tiebreak=("l_orderkey", "l_linenumber"))
    q.awaitTermination(300)
    got = merged_bars(spark, partials)
    want = build_bars(lines, key="p_brand", ts="l_shipdate", price="price", qty="l_quantity", grain="week",
                      tiebreak=("l_orderkey", "l_linenumber"))
    diff = got.exceptAll(want).count() + want.exceptAll(got).count()
    assert diff == 0
    assert got.count() == want.count()
