"""Keyed tables: atomic batches, bounded reads of the log, leveled compaction,
lookup, and errors that are not taken for absence."""
import json
import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import StreamingQueryException
from pyspark.sql.types import LongType, StringType, StructField, StructType

from postwave.session import shared_path
from postwave.sinks.writers import path_exists
from postwave.streaming import keyed
from postwave.streaming.manifest import EMPTY, EVERY, Files, ManifestLog, applied
from postwave.streaming.replay import drain

TABLE = StructType([StructField("id", StringType()), StructField("v", LongType())])
STORED = StructType([*TABLE.fields, StructField("seq", LongType())])
SOURCE = "seq long, value string, topic string"
TOPICS = {"a": (TABLE, "one"), "b": (TABLE, "two")}


def put(spark, path, rows):
    spark.createDataFrame(rows, SOURCE).coalesce(1).write.mode("append").json(path)


def run(spark, base, **more):
    stream = spark.readStream.schema(SOURCE).option("maxFilesPerTrigger", "1").json(f"{base}/in")
    drain(keyed.upsert_job(stream, f"{base}/out", f"{base}/ckpt", TOPICS, **more))


def view(spark, base, name="one"):
    return {r.id: r.v for r in keyed.read_table(spark, f"{base}/out/{name}", "id", ["seq"], TABLE).collect()}


def local(path):
    return path.removeprefix("file:")


def add_part(spark, log, name, number, rows):
    """A waiting part of the table, written and committed without a stream."""
    path = f"{name}/part-{number:06d}"
    folder = f"{local(log.base)}/{path}"
    os.makedirs(folder)
    pq.write_table(pa.table({"id": [r[0] for r in rows], "v": pa.array([r[1] for r in rows], pa.int64()),
                             "seq": pa.array([r[2] for r in rows], pa.int64())}), f"{folder}/part-0.parquet")
    ids = [r[0] for r in rows if r[0] is not None]
    file = {"path": f"{path}/part-0.parquet", "bytes": os.path.getsize(f"{folder}/part-0.parquet"), "rows": len(rows),
            "level": 0, "bucket": None, "low": min(ids, default=None), "high": max(ids, default=None)}
    log.commit(lambda s: {"tables": {name: {"add": [file], "buckets": 4, "schema": STORED.jsonValue()}},
                          "batch": {"x": number}})


def test_batch_is_seen_in_all_tables_or_none(spark, monkeypatch):
    base = shared_path(spark, "t-atomic")
    put(spark, f"{base}/in", [(1, '{"id":"p","v":1}', "a"), (2, '{"id":"q","v":2}', "b")])
    run(spark, base)
    put(spark, f"{base}/in", [(3, '{"id":"p","v":3}', "a"), (4, '{"id":"q","v":4}', "b"), (5, "{bad", "a")])
    write = keyed.write_batch

    def crash(spark, base, part, name, *rest):
        if name == "two":
            raise RuntimeError("lost")
        return write(spark, base, part, name, *rest)

    monkeypatch.setattr(keyed, "write_batch", crash)
    with pytest.raises(StreamingQueryException):
        run(spark, base)
    # the first table's files are there, but nothing names them
    assert (view(spark, base), view(spark, base, "two")) == ({"p": 1}, {"q": 2})
    assert keyed.read_rejects(spark, f"{base}/out/one").count() == 0
    monkeypatch.setattr(keyed, "write_batch", write)
    run(spark, base)
    assert (view(spark, base), view(spark, base, "two")) == ({"p": 3}, {"q": 4})
    counts = {(r.topic, r.outcome): r.records for r in keyed.read_counts(spark, f"{base}/out").collect()}
    assert counts == {("a", "indexed"): 2, ("a", "error"): 1, ("b", "indexed"): 2}


def test_committed_batch_is_not_written_again(spark, monkeypatch):
    """A batch whose commit was not noted in the stream's own checkpoint."""
    base = shared_path(spark, "t-again")
    put(spark, f"{base}/in", [(1, '{"id":"p","v":1}', "a")])
    run(spark, base)
    commits = f"{local(base)}/ckpt/commits"
    for name in os.listdir(commits):
        os.rename(f"{commits}/{name}", f"{local(base)}/{name}.was")
    before = ManifestLog(spark, f"{base}/out").state()
    run(spark, base)
    assert ManifestLog(spark, f"{base}/out").state() == before


def test_reading_ten_thousand_batches_takes_few_calls(spark):
    base = shared_path(spark, "t-calls")
    folder = f"{local(base)}/_manifest"
    os.makedirs(folder)
    state, n = EMPTY, 10_000
    for v in range(n):
        change = {"version": v, "at": 0, "batch": {"x": v}, "counts": {"a": {"indexed": 2}},
                  "tables": {"one": {"add": [{"path": f"p{v}", "level": 0}], "drop": [f"p{v - 3}"]}}, "deleted": [f"p{v - 9}"]}
        state = applied(state, change)
        with open(f"{folder}/{v:012d}.json", "w") as f:
            json.dump(change, f)
        if (v + 1) % EVERY == 0:
            with open(f"{folder}/{v:012d}.checkpoint.json", "w") as f:
                json.dump(state, f)
            with open(f"{folder}/last", "w") as f:
                f.write(str(v))
    log = ManifestLog(spark, base)
    assert log.state() == state and state["counts"] == {"a": {"indexed": 2 * n}}
    assert len(state["tables"]["one"]["files"]) == 3
    assert log.files.calls <= 2 * EVERY + 3
    # going on from there
    calls = log.files.calls
    log.commit(lambda s: {"batch": {"x": n}})
    assert log.files.calls - calls <= 5 and ManifestLog(spark, base).state()["batches"] == {"x": n}


def test_checkpoints_replace_old_changes(spark):
    base = shared_path(spark, "t-saved")
    log = ManifestLog(spark, base, every=4)
    for i in range(30):
        log.commit(lambda s: {"batch": {"x": i}, "counts": {"a": {"indexed": 1}}})
    names = sorted(x for x in os.listdir(f"{local(base)}/_manifest") if not x.startswith("."))
    assert len([x for x in names if "checkpoint" in x]) == 2 and len(names) <= 2 + 1 + 3 * 4
    assert ManifestLog(spark, base, every=4).state()["counts"] == {"a": {"indexed": 30}}


def test_two_writers_both_commit(spark):
    base = shared_path(spark, "t-writers")
    one, two = ManifestLog(spark, base), ManifestLog(spark, base)
    one.state(), two.state()
    one.commit(lambda s: {"batch": {"x": 0}})
    two.commit(lambda s: {"batch": {"y": 0}})
    one.commit(lambda s: {"batch": {"x": s["batches"]["x"] + 1}})
    assert ManifestLog(spark, base).state()["batches"] == {"x": 1, "y": 0}
    assert not one.files.create(one._change(0), "{}")


def test_compaction_rewrites_a_near_constant_share(spark):
    """200 batches; the view stays that of a full replay."""
    base = shared_path(spark, "t-levels") + "/out"
    log, replay, rewritten, held = ManifestLog(spark, base), {}, [], []
    for b in range(200):
        rows = [(f"k{b * 20 + i:05d}" if i % 4 else f"k{(b * 7 + i) % 900:05d}", b, b * 100 + i) for i in range(20)]
        rows.append((None, b, b * 100 + 99))
        replay |= {r[0] if r[0] is not None else r[2]: r[1] for r in rows}
        add_part(spark, log, "one", b, rows)
        if b % 20 == 19:
            had = {f["path"] for f in log.state()["tables"]["one"]["files"]}
            keyed.compact(spark, f"{base}/one", "id", ["seq"], TABLE, fan=2, grace_seconds=0, log=log)
            files = log.state()["tables"]["one"]["files"]
            # runs of levels that were merged on in between count too
            rewritten.append(sum(f["rows"] for f in files if f["path"] not in had))
            held.append(sum(f["rows"] for f in files))
    got = keyed.read_table(spark, f"{base}/one", "id", ["seq"], TABLE).collect()
    assert {r.id if r.id is not None else r.seq: r.v for r in got} == replay and len(got) == len(replay)
    # rewriting the whole table each time would have cost `held`
    assert sum(rewritten) < 0.45 * sum(held)
    assert sum(rewritten[5:]) < 2.5 * sum(rewritten[:5])
    runs = {}
    for f in log.state()["tables"]["one"]["files"]:
        runs[f["bucket"], f["level"]] = runs.get((f["bucket"], f["level"]), 0) + 1
    assert max(runs.values()) < 2 and max(level for _, level in runs) >= 4 and rewritten
    # replaced files are gone from the disk, live ones are all there
    on_disk = {os.path.relpath(os.path.join(d, x), local(base)) for d, _, names in os.walk(f"{local(base)}/one")
               for x in names if x.endswith(".parquet") and "-bloom" not in d}
    assert on_disk == {f["path"] for f in log.state()["tables"]["one"]["files"]}


def test_replaced_files_stay_for_readers(spark):
    base = shared_path(spark, "t-grace") + "/out"
    log = ManifestLog(spark, base)
    add_part(spark, log, "one", 0, [("a", 1, 1), ("b", 2, 2)])
    reader = keyed.read_table(spark, f"{base}/one", "id", ["seq"], TABLE)
    keyed.compact(spark, f"{base}/one", "id", ["seq"], TABLE, log=log)
    assert reader.count() == 2 and len(log.state()["retired"]) == 1
    assert keyed.retire(spark, base, 3600, log) == 0 and keyed.retire(spark, base, 0, log) == 1
    assert log.state()["retired"] == []
    assert keyed.read_table(spark, f"{base}/one", "id", ["seq"], TABLE).count() == 2


def test_only_buckets_with_new_keys_are_merged(spark):
    base = shared_path(spark, "t-touched") + "/out"
    log = ManifestLog(spark, base)
    add_part(spark, log, "one", 0, [(f"k{i}", i, i) for i in range(100)])
    keyed.compact(spark, f"{base}/one", "id", ["seq"], TABLE, fan=2, log=log)
    before = {f["path"]: f["bucket"] for f in log.state()["tables"]["one"]["files"]}
    add_part(spark, log, "one", 1, [("k1", -1, 1000)])
    keyed.compact(spark, f"{base}/one", "id", ["seq"], TABLE, fan=2, log=log)
    after = {f["path"]: f["bucket"] for f in log.state()["tables"]["one"]["files"]}
    assert len(set(before.values())) == 4
    assert len(set(before) - set(after)) == 1 and len(set(after) - set(before)) == 1


def test_lookup_opens_few_files(spark):
    base = shared_path(spark, "t-lookup") + "/out"
    log = ManifestLog(spark, base)
    for b in range(3):
        add_part(spark, log, "one", b, [(f"k{i:04d}", b, b * 1000 + i) for i in range(b * 300, b * 300 + 400)])
        keyed.compact(spark, f"{base}/one", "id", ["seq"], TABLE, fan=4, log=log)
    add_part(spark, log, "one", 9, [("k0005", 99, 99_999), ("k0050", 98, 99_998)])
    files = log.state()["tables"]["one"]["files"]
    assert len(files) == 3 * 4 + 1
    of = lambda *keys: {r.id: r.v for r in keyed.lookup(
        spark, f"{base}/one", "id", ["seq"], TABLE, list(keys)).collect()}
    opened = lambda *keys: len(keyed.lookup_files(spark, f"{base}/one", list(keys)))
    assert of("k0005", "k0350", "k0999", None) == {"k0005": 99, "k0350": 1, "k0999": 2}
    # one run of one bucket, and the waiting part where its range allows
    assert opened("k0999") <= 2 and opened("k0005") <= 3 and opened("z") == 0 and opened() == 0
    # keys that are not there: in range, but not in the filters
    absent = [f"k{i:04d}x" for i in range(60, 260)]
    assert sum(opened(k) for k in absent[:20]) <= 6
    assert len(of(*absent)) == 0 and of() == {}
    full = {r.id: r.v for r in keyed.read_table(spark, f"{base}/one", "id", ["seq"], TABLE).collect()}
    keys = sorted(full)[::3]
    assert of(*keys) == {k: full[k] for k in keys}
    with pytest.raises(ValueError, match="keys"):
        of(*map(str, range(keyed.MOST_KEYS + 1)))


def test_errors_are_not_taken_for_absence(spark):
    with pytest.raises(Py4JJavaError):
        path_exists(spark, "nosuchscheme://x/y")
    with pytest.raises(Py4JJavaError):
        Files(spark).read("nosuchscheme://x/y")
    base = shared_path(spark, "t-errors") + "/out"
    assert Files(spark).read(f"{base}/nothing") is None
    log = ManifestLog(spark, base)
    add_part(spark, log, "one", 0, [("a", 1, 1)])
    add_part(spark, log, "two", 1, [("a", 1, 1)])
    path = f"{local(base)}/{log.state()['tables']['two']['files'][0]['path']}"
    os.rename(path, path + ".was")
    spec = {n: ("id", ["seq"], TABLE) for n in ("one", "two", "three")}
    stats = {r.index_name: r.doc_count for r in keyed.index_stats_at(spark, base, spec).collect()}
    assert stats == {"one": 1, "two": -1, "three": 0}
