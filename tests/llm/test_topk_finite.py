"""The registered top-k query on vectors with components that aren't finite, against its SQL."""

import duckdb
import numpy as np

from tidebook.llm.queries import ORACLES, QUERIES


def test_non_finite_components_take_no_part(spark, tmp_path):
    rnd = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rnd.normal(size=4)]) for i in range(160)]
    for i, odd in ((0, "nan"), (7, "inf"), (8, "-inf"), (9, "nan"), (50, "inf"), (100, "-inf")):
        rows[i][1][i % 4] = float(odd)
    rows += [(200, None), (201, [1.0, None, 1.0, 1.0])]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>").coalesce(1).write.parquet(str(tmp_path / "embeddings.parquet"))
    db = duckdb.connect()
    db.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{tmp_path}/embeddings.parquet/*.parquet')")
    want = sorted(db.execute(ORACLES["op2_topk"]).fetchall())
    got = sorted(map(tuple, QUERIES["op2_topk"](spark, str(tmp_path)).select("query_id", "rank", "vec_id", "score").collect()))
    assert got == want and {r[0] for r in got} == {150} and not {r[2] for r in got} & {0, 7, 8, 9, 50, 100}
