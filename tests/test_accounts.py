from tagreef.operators.accounts import (
    apply_profile_patches,
    apply_signups,
    check_accounts,
    lookup_accounts,
)
from tagreef.plans.jobs import account_batch
from tagreef.schema import ACCOUNTS, SIGNUPS
from tagreef.sources.accounts import read_snapshot, store_account_batch, write_accounts

OLD = [(1, "bob", "h1", "bob@x"), (7, "cy", "h7", None)]
NEW = [
    (10, "Ann", 8, "ha", "ann@x"),
    (11, "ann", 8, "hb", ""),
    (12, " 　", 8, "hc", None),
    (13, "x" * 31, 8, "hd", None),
    (14, "dan", 8, "he", "e" * 51),
    (15, "eve", 0, "hf", None),
    (16, "fay", 31, "hg", None),
    (17, "BOB", 8, "hh", None),
    (18, None, 8, "hi", None),
    (9, "gus", 30, "hj", "e" * 50),
    (19, "x" * 30, None, "hk", None),
]


def frames(spark):
    return spark.createDataFrame(OLD, ACCOUNTS), spark.createDataFrame(NEW, SIGNUPS)


def test_checks(spark):
    _, signups = frames(spark)
    refused = {r["seq"] for r in check_accounts(signups).filter("status is not null").collect()}
    assert refused == {12, 13, 14, 15, 16, 18, 19}


def test_signups(spark):
    accounts, outcomes = apply_signups(*frames(spark))
    assert sorted(tuple(r) for r in accounts.collect()) == [
        *OLD, (8, "gus", "hj", "e" * 50), (9, "ann", "ha", "ann@x"),
    ]
    status = {r["seq"]: r["status"] for r in outcomes.collect()}
    assert len(status) == len(NEW)
    assert {s for s, v in status.items() if v == "Signup successful"} == {9, 10}
    assert {s for s, v in status.items() if v == "Username taken"} == {11, 17}


def test_first_signup_of_an_empty_table(spark):
    accounts, signups = frames(spark)
    grown, _ = apply_signups(accounts.limit(0), signups)
    assert sorted(r["id"] for r in grown.collect()) == [1, 2, 3]


PATCHES = [
    (1, "bob", "", "new@x"), (2, "bob", "h2", ""), (3, "bob", "h3", None), (4, "bob", "", "last@x"),
    (5, "nobody", "h", "n@x"), (6, "cy", "", ""),
]


def test_patches(spark):
    accounts, signups = frames(spark)
    patches = spark.createDataFrame(
        PATCHES, "seq long, username string, password_hash string, email string"
    )
    patched, unknown = apply_profile_patches(accounts, patches)
    assert sorted(tuple(r) for r in patched.collect()) == [
        (1, "bob", "h3", "last@x"), (7, "cy", "h7", None),
    ]
    assert [r["username"] for r in unknown.collect()] == ["nobody"]
    whole, outcomes, unknown = account_batch(accounts, signups, patches)
    assert whole.count() == 4 and outcomes.count() == len(NEW) and unknown.count() == 1


def test_lookup(spark):
    accounts, signups = frames(spark)
    assert [r["id"] for r in lookup_accounts(accounts, "cy").collect()] == [7]
    names = spark.createDataFrame([("bob",), ("bob",), ("who",)], "username string")
    assert [r["id"] for r in lookup_accounts(accounts, names).collect()] == [1]


def lines_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_accounts_are_not_shuffled(spark, tmp_path):
    path = str(tmp_path / "a")
    spark.range(3000).selectExpr("int(id) AS id", "concat('u', id) AS username", "'h' AS password_hash", "'e' AS email").write.parquet(path)
    accounts = spark.read.schema(ACCOUNTS).parquet(path)
    signups = spark.createDataFrame([(1, "u5", 8, "x", None), (2, "new", 8, "y", None)], SIGNUPS)
    patches = spark.createDataFrame([(1, "u7", "z", None), (2, "nobody", "z", None)], "seq long, username string, password_hash string, email string")
    grown, _ = apply_signups(accounts, signups)
    patched, unknown = apply_profile_patches(grown, patches)
    plan = lines_of(patched)
    assert "Exchange hashpartitioning(username" not in plan and "SortMergeJoin" not in plan
    found = {r.username: r.password_hash for r in patched.filter("password_hash <> 'h'").collect()}
    assert found == {"u7": "z", "new": "y"} and patched.count() == 3001
    assert [r.username for r in unknown.collect()] == ["nobody"]


def test_a_batch_rewrites_touched_buckets_only(spark, tmp_path):
    path = str(tmp_path / "s")
    old = spark.range(500).selectExpr("int(id) AS id", "concat('u', id) AS username", "'h' AS password_hash", "'e' AS email")
    write_accounts(old, path, 16)
    before = read_snapshot(spark, path)
    files = set(before.inputFiles())
    assert before.count() == 500 and len(files) == 16
    signups = spark.createDataFrame([(1, "U5", 8, "x", None), (2, "new", 8, "y", None)], SIGNUPS)
    patches = spark.createDataFrame([(1, "u7", "z", None)], "seq long, username string, password_hash string, email string")
    outcomes, unknown = store_account_batch(spark, path, signups, patches)
    assert {r.seq: r.status for r in outcomes.collect()} == {1: "Username taken", 2: "Signup successful"}
    assert unknown.count() == 0
    after = read_snapshot(spark, path)
    changed = after.exceptAll(before).collect()
    assert {(r.id, r.username, r.password_hash) for r in changed} == {(500, "new", "y"), (7, "u7", "z")}
    assert after.count() == 501 and before.count() == 500  # an earlier reader still finds its files
    assert len(files - set(after.inputFiles())) <= 3
    # From nothing, and with nothing to do.
    none = str(tmp_path / "none")
    write_accounts(old.limit(0), none)
    store_account_batch(spark, none, signups, patches.limit(0))
    assert sorted((r.id, r.username) for r in read_snapshot(spark, none).collect()) == [(1, "u5"), (2, "new")]
    store_account_batch(spark, none, signups.limit(0), patches.limit(0))
    assert read_snapshot(spark, none).count() == 2
