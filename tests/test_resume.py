"""A refresh that failed goes on after the last gate it passed."""

import glob

import pytest
from test_intake import files  # noqa: F401
from test_refresh import sources

from claimward.operators import gold
from claimward.plans import refresh
from claimward.sources import tables
from claimward.sources.text import read_all

BATCH = "20240101_000000"


class Killed(Exception):
    pass


class Unread(dict):
    """Raw input that must not be asked for."""

    def __getitem__(self, name):
        raise AssertionError(f"{name} was read again")


def killed_in(monkeypatch, module, name, run):
    def die(*args, **kwargs):
        raise Killed

    with monkeypatch.context() as patch:
        patch.setattr(module, name, die)
        with pytest.raises(Killed):
            run()


def content(spark, root):
    """Digest per published table, without the columns that name the load."""
    found = {}
    for row in tables.current(spark, root).collect():
        df = spark.read.parquet(row.path)
        names = [c for c in df.columns if c not in ("batch_id", "ingestion_timestamp", "load_timestamp")]
        digest = df.agg(tables.content_digest(names)).first()[0]
        found[row.layer, row.table_name] = (row.table_rows, digest)
    return found


def test_a_killed_run_goes_on_and_equals_a_fresh_one(spark, files, tmp_path, monkeypatch):  # noqa: F811
    raw = read_all(spark, sources(files), BATCH)
    fresh, root = str(tmp_path / "fresh"), str(tmp_path / "killed")
    refresh.refresh(spark, raw, fresh, BATCH)

    killed_in(monkeypatch, gold, "fact_claims", lambda: refresh.refresh(spark, raw, root, BATCH))
    assert tables.latest_version(spark, root) == 0
    with pytest.raises(tables.PublishConflict):  # the id is taken unless the run is to go on
        refresh.refresh(spark, raw, root, BATCH)
    # killed again, later: what passed before is not made again
    killed_in(
        monkeypatch, refresh.lattice, "build",
        lambda: refresh.refresh(spark, Unread(), root, BATCH, resume=True),
    )
    result = refresh.refresh(spark, Unread(), root, BATCH, resume=True)
    assert result.taken_up == ("bronze", "silver", "gold")
    assert content(spark, root) == content(spark, fresh)
    published = {(r.layer, r.table_name): r.path for r in tables.current(spark, root).collect()}
    assert published["silver", "stg_claims"].endswith(f"batch={BATCH}")
    assert published["gold", "fact_claims"].endswith(f"batch={BATCH}-again1")
    assert published["checks", "findings"].endswith(f"batch={BATCH}-again2")
    with pytest.raises(tables.PublishConflict, match="published since"):
        refresh.refresh(spark, Unread(), root, BATCH, resume=True)


def layers(spark, root, made, source="s", expected=None, stop=None, **more):
    """Three small layers, each a table over the one before; ``made`` notes which are built."""
    run = refresh.Layers(spark, root, BATCH, source, True, **{"resume": True, **more})
    value = 1
    for name in ("bronze", "silver", "gold"):

        def make(name=name, value=value):
            made.append(name)
            if name == stop:
                raise Killed
            run.keep(name, {name: spark.range(value, value + 5).selectExpr("id", "'x' AS at")})
            run.found.append((name, "check", value, "warning", True))

        frames = run.reach(name, (expected or {}).get(name), make)
        value = frames[name].agg({"id": "max"}).first()[0]
    return run


def test_layers_that_passed_are_taken_up(spark, tmp_path):
    root, made = str(tmp_path / "w"), []
    with pytest.raises(Killed):
        layers(spark, root, made, stop="gold", resume=False)
    run = layers(spark, root, made)
    assert run.taken == ["bronze", "silver"] and made == ["bronze", "silver", "gold", "gold"]
    assert [f[0] for f in run.found] == ["bronze", "silver", "gold"]
    assert [s.path.rpartition("/")[2] for s in run.staged] == [f"batch={BATCH}"] * 2 + [f"batch={BATCH}-again1"]
    assert layers(spark, root, made).taken == ["bronze", "silver", "gold"]


def test_terms_sources_and_stored_files_decide(spark, tmp_path):
    root, made = str(tmp_path / "w"), []
    layers(spark, root, made, resume=False)
    assert layers(spark, root, made, expected={"silver": {"silver": 5}}).taken == ["bronze"]
    assert layers(spark, root, made, source="other").taken == []
    # rows that came to a stored table: its layer and those behind it are made again
    spark.createDataFrame([(77, "x")], "id bigint, at string").write.mode("append").parquet(
        f"{root}/silver/silver/batch={BATCH}"
    )
    assert layers(spark, root, made).taken == ["bronze"]
    assert layers(spark, root, made).taken == ["bronze", "silver", "gold"]  # those just made


def test_a_batch_older_than_the_published_version_stays_behind(spark, tmp_path):
    root, made = str(tmp_path / "w"), []
    with pytest.raises(Killed):
        layers(spark, root, made, stop="gold", resume=False)
    other = tables.stage(spark.range(3), root, "gold", "gold", "other")
    tables.publish(spark, root, [other])
    with pytest.raises(tables.PublishConflict, match="published since"):
        layers(spark, root, made)


def test_changed_files_have_another_digest(spark, files, tmp_path):  # noqa: F811
    given = sources(files)
    before = refresh._sources_digest(spark, given)
    assert refresh._sources_digest(spark, given) == before
    with open(glob.glob(given["provider"])[0], "a", encoding="utf-8") as out:
        out.write("P3,No\n")
    assert refresh._sources_digest(spark, given) != before


def test_digests_see_rows_and_places_but_no_order(spark):
    def digest(rows, schema="a string, b string"):
        df = spark.createDataFrame(rows, schema).repartition(3)
        return df.agg(tables.content_digest(df.columns)).first()[0]

    assert digest([("x", "y"), ("u", None)]) == digest([("u", None), ("x", "y")])
    assert digest([("x", None)]) != digest([(None, "x")])
    assert digest([("x", "y")] * 2) != digest([("x", "y")])
    assert digest([("y", "x")], "b string, a string") == digest([("x", "y")])
    assert digest([]) == "0"
