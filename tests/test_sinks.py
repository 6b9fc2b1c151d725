"""Text sinks in the reference's layouts."""

from amity import mutual_friend_lists, mutual_friends, read_friends, to_text_lines, write_text


def test_tsv_and_row_styles(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", [3, 10, 9], 2.5), (2, None, [], None)],
                               "id long, name string, xs array<long>, s double")
    assert [r.value for r in to_text_lines(df, "tsv").collect()] == ["1\ta\t3,10,9\t2.5", "2\tnull\t\tnull"]
    assert [r.value for r in to_text_lines(df, "row").collect()] == ["[1,a,3,10,9,2.5]", "[2,null,,null]"]
    out = str(tmp_path / "out")
    write_text(df, out, style="tsv", single_file=True)
    assert len(list((tmp_path / "out").glob("part-*"))) == 1


def test_mutual_list_layout(spark, friends_path):
    edges = read_friends(spark, friends_path).edges
    lines = {r.value for r in to_text_lines(mutual_friend_lists(mutual_friends(edges)), "tsv").collect()}
    assert "0\t1\t2,3" in lines and "0\t8\t" in lines and "12\t13\t14" in lines


def test_reference_layouts(spark, friends_path, profiles_path, business_path, reviews_path):
    from amity import (mutual_friend_counts, mutual_friend_profiles, oldest_friend_top, read_business,
                       read_profiles, read_reviews, top_mutual_pairs_named, top_rated_businesses)
    from amity.sources import layouts as L
    edges = read_friends(spark, friends_path).edges
    prof = read_profiles(spark, profiles_path).rows
    assert "0,1\t2" in {r.value for r in L.pair_count_lines(mutual_friend_counts(edges)).collect()}
    assert [r.value for r in L.named_pair_lines(top_mutual_pairs_named(edges, prof, 1)).collect()] == \
        ["2\tAnn\tAsh\t1 A St\tBob\tBirch\t2 B St"]
    assert [r.value for r in L.profile_list_lines(mutual_friend_profiles(edges, prof, 1, 0)).collect()] == \
        ["0,1\t[Cy:12/31/1990, Cy:12/31/1990]"]
    e5 = {r.value for r in L.oldest_friend_lines(oldest_friend_top(edges, prof, "2020-06-15")).collect()}
    assert "6\t6 F St,Flint,Michigan,69" in e5 and "11\tnull,null,null,60" in e5
    assert "0\t1\t2,3" in {r.value for r in L.mutual_friend_lines(mutual_friends(edges)).collect()}
    e7 = L.row_lines(top_rated_businesses(read_business(spark, business_path).rows, read_reviews(spark, reviews_path).rows))
    assert e7.collect()[0].value.startswith("[b1,[List(Food, Bars)],12 Main St Stanford, CA,4.666")


def test_edge_table_layout(spark, friends_path, profiles_path, tmp_path):
    from amity import mutual_friend_profiles, read_profiles, write_edge_table
    edges = read_friends(spark, friends_path).edges
    write_edge_table(edges, str(tmp_path / "e"), 4)
    table = spark.read.parquet(str(tmp_path / "e"))
    assert sorted(map(tuple, table.collect())) == sorted(map(tuple, edges.collect()))
    df = mutual_friend_profiles(table, read_profiles(spark, profiles_path).rows, 1, 0)
    assert "In(src, [0,1])" in df._jdf.queryExecution().executedPlan().toString()
    assert sorted(r.friend_id for r in df.collect()) == [2, 3]


def test_single_file_is_bounded(spark, tmp_path):
    import pytest
    df = spark.range(50).repartition(5)
    write_text(df, str(tmp_path / "few"), single_file=True, max_rows=50)
    assert len(list((tmp_path / "few").glob("part-*"))) == 1
    with pytest.raises(ValueError):
        write_text(df, str(tmp_path / "many"), single_file=True, max_rows=49)
    assert not (tmp_path / "many").exists()


def test_ordered_files(spark, tmp_path):
    from amity import write_ordered_text
    df = spark.range(1000).selectExpr("id * 7919 % 1000 AS a", "id AS b").repartition(7)
    write_ordered_text(df, str(tmp_path / "out"), ["a"], 6)
    files = sorted((tmp_path / "out").glob("part-*"))
    got = [int(line.split("\t")[0]) for f in files for line in f.read_text().splitlines()]
    assert got == list(range(1000))
    sizes = [len(f.read_text().splitlines()) for f in files]
    assert len(files) == 6 and max(sizes) < 400  # no task wrote the lot


def scanned(df, column):
    """Rows that the scans reading ``column`` put out, once the plan has run."""
    plan = df._jdf.queryExecution().executedPlan()
    found, todo = [], [plan]
    while todo:
        node = todo.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        elif name.endswith("QueryStageExec"):
            todo.append(node.plan())
        elif name == "FileSourceScanExec" and column in node.simpleString(100).split("ReadSchema")[1]:
            found.append(node.metrics().get("numOutputRows").get().value())
        for i in range(node.children().size()):
            todo.append(node.children().apply(i))
    return found


def test_pair_lookup_reads_edges_once_and_few_row_groups(spark, tmp_path):
    from amity import mutual_friend_profiles, write_edge_table
    near = spark.range(20000).selectExpr("id AS src", "explode(sequence(id + 1, id + 10)) AS dst")
    write_edge_table(near, str(tmp_path / "e"), 8, row_group_bytes=64 << 10)
    edges = spark.read.parquet(str(tmp_path / "e"))
    profiles = spark.range(20020).selectExpr("id AS user_id", "'n' || id AS first_name", "'1/1/1990' AS dob_text")
    df = mutual_friend_profiles(edges, profiles, 900, 903)
    # E4 keeps what both list: 904 .. 910
    assert sorted(r.friend_id for r in df.collect()) == list(range(904, 911))
    rows = scanned(df, "src")
    assert len(rows) == 1 and rows[0] < 40_000  # of 200,000


def test_co_partitioned_tables_shuffle_no_edges(spark, tmp_path):
    from amity import max_friend_age, save_co_partitioned
    rnd = __import__("random").Random(1)
    edges = spark.createDataFrame(sorted({(rnd.randrange(300), rnd.randrange(300)) for _ in range(3000)} - {(k, k) for k in range(300)}), "src long, dst long")
    profiles = spark.range(280).selectExpr("id AS user_id", "date_add(DATE'1950-01-01', CAST(id * 50 AS INT)) AS dob")
    save_co_partitioned(edges, profiles, "co_edges", "co_profiles", 4, str(tmp_path))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = max_friend_age(spark.table("co_edges"), spark.table("co_profiles"), "2020-06-15", co_partitioned=True)
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1 and "Exchange hashpartitioning(user_id" in plan.replace("src", "user_id")
        assert sorted(map(str, df.collect())) == sorted(map(str, max_friend_age(edges, profiles, "2020-06-15").collect()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP TABLE co_edges")
        spark.sql("DROP TABLE co_profiles")
