"""Publication records, leases and retention, on folders and on whole builds."""

import os
import threading
import time
from concurrent.futures import ThreadPoolExecutor

import pytest

from loanscope.plans.build import ValidationFailed, build
from loanscope.sources import publication, storage
from loanscope.sources.publication import (
    Folder,
    Lease,
    Retention,
    current_version,
    opened,
    publish_version,
    sweep,
)
from tests.test_files_and_build import EXPECT, PERF_2019, raw, write  # noqa: F401

NOW = Retention(keep=2, grace_seconds=-1)


def make(root, name, folder="runs"):
    os.makedirs(f"{root}/{folder}/{name}/table")
    with open(f"{root}/{folder}/{name}/table/part-0", "w") as file:
        file.write(name)


def test_writers_that_meet_get_numbers_of_their_own(spark, tmp_path):
    root = str(tmp_path)
    assert current_version(spark, root) is None
    start = threading.Barrier(6)

    def publish(version):
        start.wait()
        return publish_version(spark, root, version)

    with ThreadPoolExecutor(6) as jobs:
        numbers = dict(zip("abcdef", jobs.map(publish, "abcdef"), strict=True))
    assert sorted(numbers.values()) == [1, 2, 3, 4, 5, 6]
    assert current_version(spark, root) == max(numbers, key=numbers.get)
    # The later publication is current, whatever its name.
    assert publish_version(spark, root, "0") == 7
    assert current_version(spark, root) == "0"
    assert Folder(spark, f"{root}/claims").names() == []


def test_the_loser_of_a_number_takes_the_next(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    publish_version(spark, root, "first")
    look, others = publication._records, iter(["rival", None, None, None])

    def meanwhile(spark, root):
        found = look(spark, root)
        if rival := next(others, None):
            # Another writer publishes between this writer's look and its claim.
            monkeypatch.setattr(publication, "_records", look)
            publish_version(spark, root, rival)
            monkeypatch.setattr(publication, "_records", meanwhile)
        return found

    monkeypatch.setattr(publication, "_records", meanwhile)
    assert publish_version(spark, root, "mine") == 3
    assert look(spark, root) == [(1, "first"), (2, "rival"), (3, "mine")]


def test_a_claim_without_a_record_leaves_a_gap(spark, tmp_path):
    root = str(tmp_path)
    Folder(spark, f"{root}/claims").create("000000000001")
    assert publish_version(spark, root, "a") == 2 and current_version(spark, root) == "a"
    make(root, "a")
    sweep(spark, root, "runs", NOW)
    assert Folder(spark, f"{root}/claims").names() == []


def test_sweep_keeps_what_is_needed(spark, tmp_path):
    root = str(tmp_path)
    for name in ("one", "two", "three", "four", "rejected", "building"):
        make(root, name)
    for name in ("one", "two", "three", "four"):
        publish_version(spark, root, name)
    assert sweep(spark, root, "runs") == []  # all changed just now
    reader, builder = Lease(spark, root, "one"), Lease(spark, root, "building", 60)
    assert sorted(sweep(spark, root, "runs", NOW)) == ["rejected", "two"]
    assert sorted(os.listdir(f"{root}/runs")) == ["building", "four", "one", "three"]
    assert [v for _, v in publication._records(spark, root)] == ["one", "three", "four"]
    # Leases end by release or in time, and a renewed one lasts.
    reader.release()
    later = time.time() + 120
    assert sorted(sweep(spark, root, "runs", NOW, now=later)) == ["building", "one"]
    builder.renew()
    make(root, "building")
    assert sweep(spark, root, "runs", NOW) == []
    assert sweep(spark, root, "runs", Retention(1, -1)) == ["three"]
    assert not Folder(spark, f"{root}/dropping").names()
    with pytest.raises(ValueError):
        Retention(keep=0)


def test_grace_counts_from_the_last_change_of_any_file(spark, tmp_path):
    root = str(tmp_path)
    for name in ("old", "busy", "kept"):
        make(root, name)
    publish_version(spark, root, "kept")
    long_ago = time.time() - 7200
    for name in ("old", "busy"):
        for place in (f"{root}/runs/{name}", f"{root}/runs/{name}/table", f"{root}/runs/{name}/table/part-0"):
            os.utime(place, (long_ago, long_ago))
    with open(f"{root}/runs/busy/table/part-1", "w") as file:
        file.write("x")
    assert sweep(spark, root, "runs", Retention(1, 3600)) == ["old"]


def test_a_sweep_that_ended_half_way_is_finished(spark, tmp_path):
    root = str(tmp_path)
    for name in ("a", "b", "c"):
        make(root, name)
        publish_version(spark, root, name)
    marks = Folder(spark, f"{root}/dropping")
    marks.create("a")
    marks.create("b")
    Folder(spark, f"{root}/runs").delete("a")  # deleted, but its record stands
    assert sweep(spark, root, "runs", Retention(1)) == ["b"]
    assert publication._records(spark, root) == [(3, "c")] and not marks.names()


def test_a_reader_and_a_sweep_see_each_other(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    for name in ("a", "b", "c"):
        make(root, name)
        publish_version(spark, root, name)
    with opened(spark, root, "runs") as version:
        for name in ("d", "e", "f"):
            make(root, name)
            publish_version(spark, root, name)
        sweep(spark, root, "runs", NOW)
        assert version == "c" and os.path.exists(f"{root}/runs/c/table/part-0")
    assert sweep(spark, root, "runs", NOW) == ["c"]
    # A reader that finds its version marked takes the one that is current by then.
    seen = iter(["e", "f"])
    monkeypatch.setattr(publication, "current_version", lambda *_: next(seen, "f"))
    Folder(spark, f"{root}/dropping").create("e")
    with opened(spark, root, "runs") as version:
        assert version == "f"
    assert Folder(spark, f"{root}/leases/e").names() == []


def test_builds_drop_former_runs(spark, raw):  # noqa: F811
    raw_dir, root = write(raw)
    first = build(spark, raw_dir, root, EXPECT).store
    keep_two = Retention(keep=2, grace_seconds=-1)
    with storage.opened_run(spark, root) as reader:
        stores = [build(spark, raw_dir, root, EXPECT, retention=keep_two).store for _ in range(2)]
        lines = list(raw[0][PERF_2019])
        raw[0][PERF_2019][1] = raw[0][PERF_2019][2]
        write(raw)
        with pytest.raises(ValidationFailed) as error:
            build(spark, raw_dir, root, EXPECT, retention=keep_two)
        raw[0][PERF_2019][:] = lines
        write(raw)
        stores += [build(spark, raw_dir, root, EXPECT, retention=keep_two).store for _ in range(2)]
        # The run under a lease is there as a whole; rejected and superseded ones are gone.
        assert reader.run_id == first.run_id and reader.read("curated.fact_loan_month").count() == 1120
        assert sorted(os.listdir(f"{root}/runs")) == sorted(s.run_id for s in (first, *stores[-2:]))
        assert not os.path.exists(error.value.store.path)
    storage.drop_former_runs(spark, root, keep_two)
    assert sorted(os.listdir(f"{root}/runs")) == sorted(s.run_id for s in stores[-2:])
    assert storage.current_run(spark, root).read("mart.portfolio_monthly").count() == 26
