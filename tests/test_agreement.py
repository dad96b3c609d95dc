from tessera.operators.agreement import compare_encodings

DDL = (
    "K bigint, A string, geometry struct<type:string,x:double,y:double,"
    "parts:array<array<struct<x:double,y:double>>>,wkid:int>"
)


def _g(*pts):
    return ("polyline", None, None, [[{"x": x, "y": y} for x, y in pts]], 2056)


def test_differences_are_flagged(spark):
    left = spark.createDataFrame(
        [(1, "a", _g((0.0, 0.0), (1.0, 1.0))), (2, "b", _g((5.0, 5.0))), (3, "c", None), (4, "d", _g((0.0, 0.0)))],
        DDL,
    )
    right = spark.createDataFrame(
        [(1, "a", _g((0.004, 0.0), (1.0, 0.999))), (2, "B", _g((5.0, 5.5))), (3, "c", None), (5, "e", None)],
        DDL,
    )
    got = {r.K: r for r in compare_encodings(left, right, "K", ["K", "A"]).collect()}
    assert got[1].same_attributes and got[1].coords_within_tol
    assert not got[2].same_attributes and not got[2].coords_within_tol
    assert got[3].same_attributes and got[3].coords_within_tol and got[3].n_vertices_json == 0
    assert (got[4].in_json, got[4].in_pbf, got[4].coords_within_tol) == (True, False, False)
    assert (got[5].in_json, got[5].in_pbf, got[5].same_attributes) == (False, True, False)
