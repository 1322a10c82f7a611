import pytest

from obligato.sources import stored


def rows(spark, **urls):
    return spark.createDataFrame(list(urls.items()), "key string, url string")


def content(spark, path):
    return {r.key: (r.url, r.origin) for r in stored.read_registry(spark, path).collect()}


def test_versions_follow_runs(spark, tmp_path):
    path = f"{tmp_path}/registry"
    assert stored.last_version(spark, path) is None and stored.read_registry(spark, path) is None
    assert stored.store_upsert(rows(spark, a="1", b="2"), path, "run-1").number == 1
    assert content(spark, path) == {"a": ("1", "added"), "b": ("2", "added")}
    assert stored.store_upsert(rows(spark, b="3", c="4"), path, "run-2").number == 2
    want = {"a": ("1", "original"), "b": ("3", "replaced"), "c": ("4", "added")}
    assert content(spark, path) == want
    again = stored.store_upsert(rows(spark, b="3", c="4"), path, "run-2")
    assert again.number == 2 and content(spark, path) == want


def test_a_failed_run_leaves_the_last_version(spark, tmp_path, monkeypatch):
    path = f"{tmp_path}/registry"
    stored.store_upsert(rows(spark, a="1"), path, "run-1")
    commit = stored._commit
    monkeypatch.setattr(stored, "_commit", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        stored.store_upsert(rows(spark, a="2"), path, "run-2")
    assert content(spark, path) == {"a": ("1", "added")}
    monkeypatch.setattr(stored, "_commit", commit)
    assert stored.store_upsert(rows(spark, a="2"), path, "run-2").number == 2
    assert content(spark, path) == {"a": ("2", "replaced")}


def test_of_two_runs_on_one_version_one_is_refused(spark, tmp_path):
    path = f"{tmp_path}/registry"
    stored.store_upsert(rows(spark, a="1"), path, "run-1")
    rows(spark, a="x").write.parquet(f"{path}/v-other")
    stored._commit(spark, path, stored.Version(2, "v-other", "other"))
    with pytest.raises(RuntimeError, match="another run"):
        stored._commit(spark, path, stored.Version(2, "v-mine", "mine"))
    assert stored.last_version(spark, path).run == "other"
