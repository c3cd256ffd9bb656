from priorview.operators.quality import elo_audit


def test_wrong_ratings_are_found(spark, rows):
    sides = [("f1", "a", 1, True, "win"), ("f1", "b", 1, False, "win"), ("f2", "a", 2, False, "win"), ("f2", "c", 2, True, "win"), ("f3", "a", 3, True, "win"), ("f3", "b", 3, False, "win")]
    p = spark.createDataFrame(sides, "fight_id string, fighter_id string, day int, won boolean, result_type string")
    right = {("f1", "a"): 1500.0, ("f1", "b"): 1500.0, ("f2", "a"): 1516.0, ("f2", "c"): 1500.0, ("f3", "a"): 1499.0, ("f3", "b"): 1484.0}
    audit = lambda elo: rows(elo_audit(spark.createDataFrame([(*k, v) for k, v in elo.items()], "fight_id string, fighter_id string, pre_fight_elo double"), p))
    assert audit(right) == [("debut_elo", 3, 0), ("elo_direction", 3, 0)]
    # c starts with what it gains in that bout; a falls after its win; b rises after its loss.
    assert audit(right | {("f2", "c"): 1516.0, ("f2", "a"): 1490.0, ("f3", "b"): 1510.0}) == [("debut_elo", 3, 1), ("elo_direction", 3, 3)]
