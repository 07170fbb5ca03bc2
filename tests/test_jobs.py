from dataclasses import replace

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ratingloom import schemas
from ratingloom.config import PRESET_A, SplitConfig
from ratingloom.operators import append, predict, profile, registry
from ratingloom.plans import conflicts, pipeline, submissions
from ratingloom.plans import manifest as manifest_module
from ratingloom.plans import store as store_module
from ratingloom.plans.manifest import Manifest
from ratingloom.plans.recommender import Recommender
from ratingloom.plans.store import Store
from ratingloom.sources.buckets import gather, write_bucketed
from ratingloom.streaming.uploads import ingest_uploads
from tests.conftest import rows_of

QUICK = replace(PRESET_A, max_iter=2, rank=3)


def write_csv(tmp_path):
    """20 items and ratings of users 0 to 14 in the layout of the public film data sets."""
    items, ratings = tmp_path / "items.csv", tmp_path / "ratings.csv"
    items.write_text("movieId,title,genres\n" + "".join(
        f'{k},"Film {k}, The",Drama\n' for k in range(20)
    ))
    ratings.write_text("userId,movieId,rating,timestamp\n" + "".join(
        f"{u},{i},{(u + i) % 10 / 2 + 0.5},{1_000_000 + u}\n"
        for u in range(15) for i in range(20) if (u * i) % 3
    ))
    return str(items), str(ratings)


@pytest.fixture
def trained(spark, tmp_path):
    return Recommender.train(spark, str(tmp_path / "store"), *write_csv(tmp_path), als=QUICK)


def test_training_writes_a_version(trained):
    log = trained.store.model_log().collect()
    assert len(log) == 1 and log[0].version == 1
    assert log[0].n_ratings == trained.ratings.count() == log[0].n_train + log[0].n_test
    assert log[0].max_user_id == 14 and log[0].rmse is not None
    parts = {p: trained.store.ratings(1, p).count() for p in ("train", "test")}
    assert parts == {"train": log[0].n_train, "test": log[0].n_test}


def test_train_files_alone_are_read(trained, capsys):
    trained.store.ratings(1, "train").select("user_id").explain()
    plan = capsys.readouterr().out
    pruned = plan.split("PartitionFilters: ")[1].split("PushedFilters")[0]
    assert "= train" in pruned and "<= 1" in pruned


def test_user_filters_reach_the_files(trained, capsys):
    trained.store.ratings(1).filter("user_id = 4").explain()
    assert "EqualTo(user_id,4)" in capsys.readouterr().out


def test_a_hot_user_is_spread_over_files_and_counted_once(spark, tmp_path):
    rows = spark.range(0, 90_000, 1, 12).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 500).alias("user_id"),
        (F.col("id") % 1000).alias("item_id"), F.lit(2.0).alias("rating"),
    )
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        store = Store.create(spark, str(tmp_path / "s"))
        store.append(rows, "hot")
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    totals = store.totals(1)
    assert totals["n_ratings"] == store.ratings().count() == 90_000
    assert totals["n_train"] == store.ratings(part="train").count()
    files = store.ratings().filter("user_id = 7").groupBy(F.input_file_name()).count().collect()
    assert len(files) > 2 and max(r["count"] for r in files) < 20_000


def test_a_bucket_too_large_for_one_task_is_not_read_as_one(spark, tmp_path, monkeypatch, capsys):
    rows = spark.range(6000).selectExpr("if(id % 3 = 0, 7, id % 500) as user_id", "id % 100 as item_id", "2.0D as rating")
    store = Store.create(spark, str(tmp_path / "s"))
    store.append(rows, "hot")
    largest = store.rating_log().first().largest_bucket
    assert store.even_buckets(1) and largest > 0
    monkeypatch.setattr(store_module, "BUCKET_BYTES", largest - 1)
    assert not store.even_buckets(1)
    assert store.ratings(by_user=True).count() == 6000
    store.ratings(by_user=True).explain()
    assert "Bucketed: true" not in capsys.readouterr().out


def test_test_rows_meet_user_factors_where_they_lie(trained, spark, capsys):
    store = trained.store
    store.append(spark.createDataFrame([(3, 19, 2.0), (99, 1, 3.0)], schemas.RATINGS), "more")
    test = store.ratings(by_user=True)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as if the factors were large
    try:
        found = predict.predict(trained.model, test, store.user_factors(1))
        rows = rows_of(found)
        capsys.readouterr()
        predict.predict(trained.model, test, store.user_factors(1)).explain()
        plan = capsys.readouterr().out
        plain = rows_of(predict.predict(trained.model, store.ratings()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert rows == plain and {r[-1] for r in rows} == {"ok", "unknown_user"}
    assert "Exchange hashpartitioning" not in plan and plan.count("Bucketed: true") == 2


def test_a_manifest_is_one_file_whatever_was_added(spark, tmp_path, monkeypatch):
    schema = StructType.fromDDL("n bigint, name string, x double")
    manifest = Manifest(spark, str(tmp_path))
    assert manifest.versions() == [] and manifest.log("a", schema).count() == 0
    monkeypatch.setattr(manifest_module, "KEPT", 3)
    rows = [(k, f'"{k}"\nü', None if k % 2 else k / 3) for k in range(8)]
    for row in rows:
        manifest.add("a", schema, row)
    manifest.add("b", schema, (1, None, None), (None, None, None))
    assert manifest.versions() == [6, 7, 8] and manifest.entries().inputFiles()[0].endswith("v0000000008.json")
    assert rows_of(manifest.log("a", schema)) == rows and manifest.log("b", schema).count() == 2
    assert len(manifest.entries(7).collect()) == 8  # an earlier version is as it was
    assert not [f for f in (tmp_path / "manifest").iterdir() if f.name.startswith("_writing")]


def test_a_writer_that_dies_or_comes_late_loses_nothing(spark, tmp_path, monkeypatch):
    schema = StructType.fromDDL("n bigint")
    manifest = Manifest(spark, str(tmp_path))
    manifest.add("a", schema, (1,))
    put = Manifest._put

    def die(*given):
        raise KeyboardInterrupt

    monkeypatch.setattr(Manifest, "_put", die)
    with pytest.raises(KeyboardInterrupt):
        manifest.add("a", schema, (2,))
    assert rows_of(manifest.log("a", schema)) == [(1,)]

    def overtaken(self, folder, version):
        monkeypatch.setattr(Manifest, "_put", put)
        Manifest(spark, str(tmp_path)).add("a", schema, (3,))
        return put(self, folder, version)

    monkeypatch.setattr(Manifest, "_put", overtaken)
    manifest.add("a", schema, (4,))
    assert rows_of(manifest.log("a", schema)) == [(1,), (3,), (4,)] and len(manifest.versions()) == 3


def files_read(table):
    """Files that the scans of a query without a shuffle open."""
    leaves = table._jdf.queryExecution().executedPlan().collectLeaves()
    scans = [leaves.apply(k) for k in range(leaves.size())]
    return sum(len(part.files()) for scan in scans for part in scan.inputRDD().partitions())


def test_few_users_open_the_files_of_their_buckets(spark, make, tmp_path, monkeypatch):
    rows = spark.range(20_000).selectExpr("id % 3001 as user_id", "id % 100 as item_id", "2.0D as rating")
    store = Store.create(spark, str(tmp_path / "s"))
    for name, mod in (("a", 0), ("b", 1)):
        store.append(rows.filter(F.col("item_id") % 2 == mod), name)
    users = make([(7,), (7,), (None,), (5000,)], "user_id bigint")
    expected = rows_of(rows.filter("user_id = 7"))
    columns = ["user_id", "item_id", "rating"]
    assert rows_of(store.ratings_of(users).select(*columns)) == expected
    assert rows_of(store.ratings_of(users, on_conflict="latest").select(*columns)) == rows_of(rows.filter("user_id = 7").distinct())
    one = store.ratings_of(make([(7,)], "user_id bigint")).select(*columns)
    everything = files_read(store.ratings(by_user=True))
    assert 0 < files_read(one) <= everything // 4
    assert store.ratings_of(make([], "user_id bigint")).count() == 0
    monkeypatch.setattr(store_module, "FEW_USERS", 1)
    assert rows_of(store.ratings_of(users).select(*columns)) == expected


def test_long_keys_have_bloom_filters(spark, tmp_path):
    path = str(tmp_path / "wide")
    keys = spark.range(0, 400_000).selectExpr("id * 7919 as user_id")
    write_bucketed(gather(keys, "user_id", 1), path, "user_id", 1)
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    file = next(p for p in (tmp_path / "wide").iterdir() if p.suffix == ".parquet")
    footer = jvm.org.apache.parquet.hadoop.ParquetFileReader.readFooter(conf, jvm.org.apache.hadoop.fs.Path(str(file)))
    assert footer.getBlocks().get(0).getColumns().get(0).getBloomFilterOffset() > 0


def test_what_is_superseded_is_written_once(trained, make, spark, capsys):
    store = trained.store
    store.append(make([(3, 2, 0.5), (3, 2, 1.5), (3, 19, 1.0), (80, 1, 1.0)], schemas.RATINGS), "a")
    store.append(make([(3, 2, 4.5), (81, 1, 1.0), (80, 1, 2.0)], schemas.RATINGS), "b")
    for upto in (3, 2, 1):  # any version, in any order
        rows = store.stored(upto)
        expected = rows_of(append.latest_ratings(rows, "batch"))
        assert rows_of(store.ratings(upto, on_conflict="latest").select("user_id", "item_id", "rating", "rated_at")) == expected
        for part in ("train", "test"):
            own = rows_of(append.latest_ratings(rows.filter(F.col("part") == part), "batch"))
            assert rows_of(store.ratings(upto, part, "latest").select("user_id", "item_id", "rating", "rated_at")) == own
        counts = rows_of(append.latest_ratings(rows, "batch").groupBy("item_id").count())
        assert rows_of(store.item_counts(upto, "latest")) == counts
        assert rows_of(store.item_counts(upto)) == rows_of(rows.groupBy("item_id").count())
    capsys.readouterr()
    store.ratings(on_conflict="latest").explain()
    assert "Aggregate" not in capsys.readouterr().out
    assert store._log("settled_log", conflicts.SETTLED_LOG).count() == 3
    log = pipeline.refit(store, QUICK, on_conflict="latest").first()
    assert log.n_ratings == store.ratings(on_conflict="latest").count()
    view = Recommender(store, als=QUICK)
    assert rows_of(view.popular()) == rows_of(profile.popular_items(view.items, view.ratings))


def test_popular_items_follow_appends_by_one_scan_of_the_batch(trained, make, spark):
    store = trained.store
    before = rows_of(trained.popular())
    assert before == rows_of(profile.popular_items(trained.items, trained.ratings))
    store.append(make([(3, 2, 0.5), (3, 2, 1.5), (90, 19, 1.0)], schemas.RATINGS), "a")
    assert rows_of(trained.popular()) == before  # the view stays
    counts = rows_of(store.item_counts())
    assert counts == rows_of(store.ratings().groupBy("item_id").count())
    files = store.item_counts().inputFiles()
    assert files and all("/counts/batch=" in f for f in files)


def test_adding_ratings_makes_a_new_view(trained, make):
    new = make([(50, i, 4.0) for i in range(12)] + [(None, 1, 3.0), (51, 1, None)], schemas.RATINGS)
    after = trained.add_ratings(new, source="batch-1")
    assert (trained.version, after.version) == (1, 2)
    assert after.ratings.count() == trained.ratings.count() + 12
    known = make([(0, 50), (1, 51)], schemas.USER_REQUESTS)
    # who exists is asked of the store as it is now, by an older view too
    assert [r.known for r in trained.known_users(known).orderBy("request_id").collect()] == [
        True, False
    ]
    assert [r.known for r in after.known_users(known).orderBy("request_id").collect()] == [
        True, False
    ]
    pair = make([(50, 4)], schemas.PAIRS)
    assert trained.predict(pair).first().status == "unknown_user"
    assert after.predict(pair).first().status == "ok"
    assert after.report(pair).first().title == "Film 4, The"
    user = make([(50,)], schemas.USERS)
    assert set(rows_of(after.ratings_for(user))) == {(50, i, 4.0) for i in range(12)}
    assert after.recommend(3, user).count() == 3
    unseen = after.recommend(30, user, exclude_seen=True)
    assert {r.item_id for r in unseen.collect()}.isdisjoint(range(12))
    assert after.popular(5).count() == 5
    assert after.sample_items(2).count() == after.sample_items(2, pool="all").count() == 2
    assert after.find_items(make([(1,), (99,)], "item_id bigint")).filter("status='ok'").count() == 1


def test_a_replayed_append_adds_nothing(trained, make):
    rows = make([(60, 1, 2.0)], schemas.RATINGS)
    first = trained.store.append(rows, "upload-7")
    assert trained.store.append(rows, "upload-7") == first
    assert trained.store.ratings().filter("user_id = 60").count() == 1


def test_an_unfinished_batch_stays_invisible(trained, make, spark):
    before = trained.store.ratings().count()
    lost = make([(70, 1, 2.0)], schemas.RATINGS).select(
        "*", F.lit(None).cast("timestamp").alias("rated_at"), F.lit("train").alias("part")
    )
    lost.write.partitionBy("part").parquet(f"{trained.store.path}/ratings/batch=2")
    assert trained.store.ratings().count() == before
    batch = trained.store.append(make([(71, 1, 2.0), (71, 2, 2.0)], schemas.RATINGS), "again")
    assert batch == 2
    assert trained.store.ratings().count() == before + 2
    assert trained.store.ratings().filter("user_id = 70").count() == 0


def test_empty_batches_and_stores(spark, tmp_path, make):
    store = Store.create(spark, str(tmp_path / "s"), SplitConfig(seed=5))
    assert store.ratings().count() == 0 and store.latest_version() is None
    assert store.totals(0) == {
        "n_ratings": 0, "n_train": 0, "n_test": 0, "n_rejected": 0, "max_user_id": 0
    }
    with pytest.raises(LookupError):
        store.model()
    store.append(make([], schemas.RATINGS), "nothing")
    assert store.latest_batch() == 1 and store.ratings().count() == 0
    assert Store(spark, store.path).split == SplitConfig(seed=5)


def test_latest_ratings_can_be_fitted(spark, tmp_path, make):
    store = Store.create(spark, str(tmp_path / "s"))
    rows = [(u, i, 3.0) for u in range(10) for i in range(10)]
    store.append(make(rows, schemas.RATINGS), "a")
    store.append(make([(u, i, 4.0) for u, i, _ in rows[:40]], schemas.RATINGS), "b")
    assert store.ratings().count() == 140
    newest = store.ratings(on_conflict="latest")
    assert newest.count() == 100 and newest.filter("rating = 4").count() == 40
    log = pipeline.refit(store, QUICK, on_conflict="latest").first()
    assert log.n_ratings == log.n_train + log.n_test == 100


def test_an_untimed_batch_beats_an_older_time(spark, tmp_path, make):
    store = Store.create(spark, str(tmp_path / "s"))
    timed = make([(1, 1, 1.0)], schemas.RATINGS).withColumn("rated_at", F.current_timestamp())
    store.append(timed, "a")
    store.append(make([(1, 1, 0.5)], schemas.RATINGS), "b")
    assert store.ratings(on_conflict="latest").first().rating == 0.5


def test_other_rows_under_a_used_source_are_an_error(trained, make):
    trained.store.append(make([(60, 1, 2.0)], schemas.RATINGS), "s")
    with pytest.raises(ValueError, match="other rows"):
        trained.store.append(make([(60, 1, 3.0)], schemas.RATINGS), "s")


def test_two_refits_are_two_versions_and_old_views_stay(trained, make, spark):
    store = trained.store
    pair = make([(1, 4)], schemas.PAIRS)
    before = trained.report(pair).collect()
    store.put_items(make([(4, "Other", "x")], schemas.ITEMS))
    assert pipeline.refit(store, QUICK).first().version == 2
    assert pipeline.refit(store, replace(QUICK, max_iter=1)).first().version == 3
    assert store.model_log().count() == 3
    old = Recommender(store, version=1, als=QUICK)
    assert old.report(pair).collect() == before and before[0].title == "Film 4, The"
    assert Recommender(store, als=QUICK).report(pair).first().title == "Other"
    moved = Store(spark, store.compact())
    assert moved.ratings().exceptAll(store.ratings()).isEmpty()
    assert store.ratings().exceptAll(moved.ratings()).isEmpty()
    assert Recommender(moved, version=1, als=QUICK).report(pair).collect() == before


def test_created_users_stay_taken(trained, make):
    ask = make([(0, None), (1, None)], schemas.USER_REQUESTS)
    first, second = trained.create_users(ask), trained.create_users(ask, source="x")
    ids = [r.user_id for r in first.unionByName(second).collect()]
    assert sorted(ids) == [15, 16, 17, 18]
    assert rows_of(trained.create_users(ask, source="x")) == rows_of(second)
    known = trained.known_users(make([(0, 16), (1, 19)], schemas.USER_REQUESTS))
    assert {r.user_id: r.known for r in known.collect()} == {16: True, 19: False}
    with pytest.raises(ValueError, match="more than once"):
        trained.create_users(make([(0, None), (0, 3)], schemas.USER_REQUESTS))


def test_input_is_computed_once_per_append(spark, tmp_path):
    met = spark.sparkContext.accumulator(0)

    def count(frames):
        for frame in frames:
            met.add(len(frame))
            yield frame

    rows = spark.range(500).selectExpr("id as user_id", "id as item_id", "2.0D as rating")
    Store.create(spark, str(tmp_path / "s")).append(rows.mapInPandas(count, rows.schema), "a")
    assert met.value == 500


def forms_of(spark, rows):
    schema = schemas.T.StructType([*schemas.USER_REQUESTS.fields,
                                   schemas.T.StructField("fields", schemas.FORM_FIELDS)])
    named = [
        (r, u, [(f"f{k}", v) for k, v in enumerate(values)]) for r, u, values in rows
    ]
    return spark.createDataFrame(named, schema)


def test_forms_create_users_and_add_their_ratings(trained, spark):
    forms = forms_of(spark, [
        (0, None, ["Film 1, The", "1", "5", "", "2", "4"]),
        (1, 4, ["Film 2, The", "2", "1", "Film 3, The", "3", "2"]),
        (2, 77, ["Film 4, The", "4", "x"]),
        (3, None, []),
    ])
    after, summary = trained.submit(forms, source="forms-1")
    assert [tuple(r) for r in summary.orderBy("request_id").collect()] == [
        (0, 15, True, 1), (1, 4, False, 2), (2, 16, True, 0), (3, 17, True, 0)
    ]
    again, same = trained.submit(forms, source="forms-1")
    assert rows_of(same) == rows_of(summary) and again.ratings.count() == after.ratings.count()
    assert after.store.rejects().count() == 1
    added = after.ratings.drop("rated_at").exceptAll(trained.ratings.drop("rated_at"))
    assert rows_of(added) == [(15, 1, 5.0), (4, 2, 1.0), (4, 3, 2.0)]
    users = submissions.submitting_users(forms, trained.ratings, mode="range")
    assert [r.user_id for r in users.orderBy("request_id").collect()] == [15, 4, 77, 78]


def upload(folder, user, name, text):
    target = folder / f"user_id={user}"
    target.mkdir(parents=True, exist_ok=True)
    (target / name).write_text(text)


def test_uploaded_files_are_added(trained, tmp_path):
    upload(tmp_path / "in", 30, "a.csv", "1,5\n2,bad\n3,11\n")
    after = trained.upload(str(tmp_path / "in"), source="upload-1", max_rating=10)
    added = after.ratings.drop("rated_at").exceptAll(trained.ratings.drop("rated_at"))
    assert rows_of(added) == [(30, 1, 5.0)]


def test_waiting_files_are_taken_in_once(trained, tmp_path):
    inbox, checkpoint = tmp_path / "in", str(tmp_path / "checkpoint")
    before = trained.store.ratings().count()
    upload(inbox, 30, "a.csv", "1,5\nbad\n")
    ingest_uploads(trained.store, str(inbox), checkpoint).awaitTermination()
    assert trained.store.ratings().count() == before + 1
    upload(inbox, 31, "b.csv", "2,4\n3,4\n")
    ingest_uploads(trained.store, str(inbox), checkpoint).awaitTermination()
    assert trained.store.ratings().count() == before + 3
    assert rows_of(trained.store.ratings().filter("user_id = 31").select("item_id")) == [(2,), (3,)]
    assert pipeline.refit(trained.store, QUICK).first().batch == 3
    ingest_uploads(trained.store, str(inbox), str(tmp_path / "other")).awaitTermination()
    assert trained.store.ratings().count() == before + 6
    assert trained.store.rejects().count() == 2


def test_the_table_of_users_takes_in_answers_and_batches(spark, make, tmp_path, monkeypatch):
    """Merged after every two answers: the same users and ids, few folders to read, no old batches."""
    monkeypatch.setattr(store_module, "WAITING", 2)
    schema = "user_id bigint, item_id bigint, rating double"
    store = Store.create(spark, str(tmp_path / "s"))
    store.append(make([(1, 1, 4.0), (2, 1, 3.0), (2, 2, 1.0)], schema), "first")
    known = {1, 2}
    for turn in range(7):
        if turn == 3:
            store.append(make([(40, 1, 4.0), (1, 2, 3.0)], schema), "second")
            known.add(40)
        requests = make([(1, None), (2, 2), (3, None)], schemas.USER_REQUESTS)
        allocated = registry.allocate_users(requests, store.users(), "exists", store.largest_user_id())
        answer = store.put_users(allocated, f"turn-{turn}")
        new = {r.user_id for r in answer.collect() if r.is_new}
        assert len(new) == 2 and not new & known
        known |= new
        assert {r.user_id for r in store.users().collect()} == known
        assert len(store.waiting_answers()) <= 2
    store.merge_users()
    assert store.waiting_answers() == []
    batch, folder = store._registry()
    assert batch == 2 and sorted(r.user_id for r in store.registered(folder).collect()) == sorted(known)
    moved = Store(spark, store.compact())
    assert {r.user_id for r in moved.users().collect()} == known
