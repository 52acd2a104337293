"""The three runs over one small site, by function and by command line."""

import json
import shutil
import sys
from datetime import timedelta

from pyspark.sql.types import StructType

from sitewatch import __main__ as command
from sitewatch.operators import history as history_ops
from sitewatch.operators.views import latest_scrape_history
from sitewatch.plans.discover import discover
from sitewatch.plans.observe import observe
from sitewatch.plans.status import register_views, run_checks
from sitewatch.schemas import FETCHES, HISTORY, REGISTRY
from sitewatch.schemas import NOT_FOUND as NF
from sitewatch.sources.snapshots import create_table, current_version, read_snapshot
from sitewatch.sources.tables import append_history, create_history, read_csv, read_history
from sitewatch.streaming.latest import create_latest, follow_history, history_stream, merge_latest, read_latest
from tests.helpers import T0, T1, T2, T3, rows

SITE = "https://s.org/#!/"


def page(*targets, user=None):
    links = "".join(f'<a href="{SITE}{t}">{t}</a>' for t in targets)
    field = f'<i id="usuario-atualizacao-pagina">{user}</i>' if user else ""
    return f'<html><body>{links}<div id="idCorpoRodape">Por {field}</div></body></html>'


def site(spark, *more):
    return spark.createDataFrame(
        [
            (SITE, page("a", "a/b", "a_b"), T0),
            (SITE + "a", page("", user="Ana"), T0),
            (SITE + "a/b/", page("a", user="Bia"), T0),
            (SITE + "a_b", page("a", user="Cai"), T0),
            (SITE + "leaf", page(user="Dri"), T0),
            *more,
        ],
        FETCHES,
    )


def test_discover_observe_status(spark, tmp_path):
    registry, history = str(tmp_path / "registry"), str(tmp_path / "history")
    create_table(spark, registry, REGISTRY)
    create_history(spark, history)
    fetches = site(spark)

    nothing = discover(spark, fetches, registry, "https://other.org/#!/", T1)
    assert nothing["pages_found"] == 0
    assert current_version(spark, registry) == 0

    first = discover(spark, fetches, registry, SITE, T1)
    assert (first["pages_found"], first["pages_upserted"]) == (3, 2)
    assert rows(spark.read.parquet(first["collisions"]), "url") == [(SITE + "a_b",)]
    assert rows(read_snapshot(spark, registry, REGISTRY)) == [
        ("a", SITE + "a", True, T1),
        ("a_b", SITE + "a/b", True, T1),
    ]

    assert observe(spark, registry, fetches, history, T1)["rows_saved"] == 2
    later = site(spark, (SITE + "a", page("new", user="Eva"), T2), (SITE + "new", page("a"), T2))
    second = discover(spark, later, registry, SITE, T2)
    assert second["pages_found"] == 4
    assert observe(spark, registry, later, history, T2)["rows_saved"] == 3

    views = register_views(
        read_snapshot(spark, registry, REGISTRY), read_history(spark, history), "run_"
    )
    status = spark.sql(
        "SELECT page_id, last_updated_by, last_scrape_timestamp FROM run_vw_page_current_status"
    )
    assert rows(status) == [("a", "Eva", T2), ("a_b", "Bia", T2), ("new", NF, T2)]
    assert [r["page_id"] for r in views["vw_page_current_status"].collect()] == ["a", "a_b", "new"]
    assert all(failures == 0 for *_, failures in rows(run_checks(spark, "run_")))


def test_without_active_pages_nothing_is_written(spark, tmp_path):
    registry, history = str(tmp_path / "registry"), str(tmp_path / "history")
    create_table(spark, registry, REGISTRY)
    create_history(spark, history)
    result = observe(spark, registry, site(spark), history, T1)
    assert result == {"pages_loaded": 0, "rows_saved": 0}
    assert not list((tmp_path / "history").glob("run_date=*"))


def test_command_line(spark, tmp_path, monkeypatch, capsys):
    fetches, registry = str(tmp_path / "fetches"), str(tmp_path / "registry")
    history, out = str(tmp_path / "history"), str(tmp_path / "status")
    site(spark).write.parquet(fetches)

    def run(*arguments):
        monkeypatch.setattr(sys, "argv", ["sitewatch", *arguments])
        command.main()
        return json.loads(capsys.readouterr().out.strip().splitlines()[-1])

    created = run("create", "--registry", registry, "--history", history)["created"]
    assert created == [registry, history]
    common = ["--registry", registry, "--run-ts", "2025-03-02T12:00:00"]
    found = run("discover", *common, "--fetches", fetches, "--start-url", SITE)
    assert found["pages_upserted"] == 2
    assert run("observe", *common, "--fetches", fetches, "--history", history)["rows_saved"] == 2
    checks = run("status", "--registry", registry, "--history", history, "--out", out)["checks"]
    assert len(checks) == 8 and not any(c["failures"] for c in checks)
    assert rows(spark.read.parquet(out), "page_id", "last_updated_by") == [("a", "Ana"), ("a_b", "Bia")]
    exported = run("export", "--registry", registry, "--history", history,
                   "--out", str(tmp_path / "csv"))["exported"]
    assert rows(read_csv(spark, exported[0], REGISTRY)) == rows(read_snapshot(spark, registry, REGISTRY))
    assert rows(read_csv(spark, exported[1], HISTORY, multiline=True)) == rows(
        read_history(spark, history))


def test_stream_keeps_the_latest_view(spark, tmp_path):
    path, root = str(tmp_path / "history"), str(tmp_path / "latest")
    create_latest(spark, root, buckets=8)
    create_history(spark, path)
    pages = spark.createDataFrame([(p, "u", True, T0) for p in "abc"], REGISTRY)

    def append(*data):
        seen = [(p, t, NF, w, NF, NF) for p, t, w in data]
        schema = [f for f in HISTORY if f.name != "id"]
        append_history(spark, path, spark.createDataFrame(seen, StructType(schema)), pages)

    def follow(checkpoint="one"):
        stream = history_stream(spark, path, maxFilesPerTrigger=1)
        follow_history(stream, path, root, str(tmp_path / checkpoint)).awaitTermination()
        return read_latest(spark, root)

    def latest():
        return rows(latest_scrape_history(read_history(spark, path)))

    append(("a", T1, "Ana"), ("b", T1, "Bia"))
    append(("a", T2, "Cai"))
    assert rows(follow()) == latest()
    # Late and new rows in one later run; the older one must not win.
    append(("a", T0, "late"), ("c", T1, "Eva"))
    got = follow()
    assert rows(got) == latest()
    assert rows(follow()) == rows(got)
    # A run that is half written is not seen, a lost checkpoint loses nothing.
    read_history(spark, path).write.parquet(f"{path}/data/run=broken")
    append(("b", T2, "Flo"))
    assert rows(follow("two")) == latest()
    assert ("b", T2, "Flo") in rows(read_latest(spark, root), "page_id", "scrape_timestamp", "updated_by")
    # A batch that is replayed changes nothing.
    shutil.rmtree(tmp_path / "two" / "commits")
    assert rows(follow("two")) == latest()


def test_untouched_buckets_keep_their_files(spark, tmp_path):
    root = str(tmp_path / "latest")
    create_latest(spark, root, buckets=16)

    def seen(first_id, pages, time):
        data = [(first_id + k, p, time, NF, "w", NF, NF) for k, p in enumerate(pages)]
        return spark.createDataFrame(data, HISTORY)

    def files():
        return {str(f): f.stat().st_mtime_ns for f in (tmp_path / "latest" / "data").glob("bucket=*/*.parquet")}

    pages = [f"p{k}" for k in range(100)] + [None]
    first = seen(1, pages, T1)
    merge_latest(first, root)
    before, own = files(), {}
    for row in spark.read.parquet(f"{root}/data").collect():
        own.setdefault(row.bucket, set()).add(row.page_id)
    assert len(own) == 16 and len(before) == 16
    merge_latest(seen(500, ["p7"], T2), root)
    after = files()
    assert len(set(before.items()) - set(after.items())) == 1
    everything = first.unionByName(seen(500, ["p7"], T2))
    assert rows(read_latest(spark, root)) == rows(latest_scrape_history(everything))
    # An older row changes nothing; what a failure left half replaced is replaced again.
    merge_latest(seen(0, ["p7"], T0), root)
    assert rows(read_latest(spark, root)) == rows(latest_scrape_history(everything))
    (bucket,) = (b for b, own_pages in own.items() if "p7" in own_pages)
    whole = spark.read.parquet(f"{root}/data").where(f"bucket = {bucket}")
    whole.write.parquet(f"{root}/pending")
    shutil.rmtree(f"{root}/data/bucket={bucket}")
    merge_latest(seen(900, ["p8"], T2), root)
    everything = everything.unionByName(seen(900, ["p8"], T2))
    assert rows(read_latest(spark, root)) == rows(latest_scrape_history(everything))
    merge_latest(first.limit(0), root)
    assert rows(read_latest(spark, root)) == rows(latest_scrape_history(everything))


def test_only_the_newest_active_page_is_parsed(spark, tmp_path, monkeypatch):
    old = [(f"{SITE}a", f"old {i}", T0 + timedelta(minutes=i)) for i in range(100)]
    fetches = spark.createDataFrame(
        old + [(f"{SITE}a", "new", T2), (f"{SITE}b", "inactive", T1)], FETCHES
    )
    parsed = []

    plain = history_ops.extract_footers
    monkeypatch.setattr(
        history_ops, "extract_footers", lambda f: (parsed.extend(r["html"] for r in f.collect()), plain(f))[1]
    )
    active = spark.createDataFrame([("a", f"{SITE}a")], "id string, url string")
    assert len(history_ops.observe_pages(active, fetches, T3).collect()) == 1
    assert parsed == ["new"]
