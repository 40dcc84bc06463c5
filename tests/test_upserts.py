"""The upsert table: newest rows win, crashes lose nothing, replays change nothing."""

import datetime as dt

import pytest

from tidemark.streaming import windows as sw
from tidemark.streaming.upserts import UpsertTable

SCHEMA = "window_end timestamp, url string, cnt bigint"


def at(day, hour=0):
    return dt.datetime(2024, 1, day, hour)


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def batch(spark, *items):
    return spark.createDataFrame([(at(d, h), u, n) for d, h, u, n in items], SCHEMA)


FIRST = [(1, 1, "a", 1), (1, 1, "b", 2), (2, 5, "a", 3)]
SECOND = [(1, 1, "a", 9), (3, 0, "c", 4)]
WANT = [(at(1, 1), "a", 9), (at(1, 1), "b", 2), (at(2, 5), "a", 3), (at(3), "c", 4)]


def table(spark, tmp_path, keys=("window_end", "url")):
    return UpsertTable(spark, str(tmp_path / "t"), keys)


def test_newest_rows_win_and_replays_are_skipped(spark, tmp_path):
    t = table(spark, tmp_path)
    assert t.read() is None
    assert t.commit(batch(spark, *FIRST), 0) and t.commit(batch(spark, *SECOND), 1)
    assert not t.commit(batch(spark, (1, 1, "a", 77)), 1) and not t.commit(batch(spark, *FIRST), 0)
    assert rows(t.read(), "window_end", "url", "cnt") == WANT
    assert rows(t.read([at(1).date()]), "url", "cnt") == [("a", 9), ("b", 2)]
    assert t.commit(batch(spark).limit(0), 2) and rows(t.read(), "window_end", "url", "cnt") == WANT


@pytest.mark.parametrize("where", ["_write", "_publish"])
def test_killed_batch_loses_nothing(spark, tmp_path, monkeypatch, where):
    """A batch dies before or after its files are written; its replay makes it count once."""
    t = table(spark, tmp_path)
    t.commit(batch(spark, *FIRST), 0)
    real = getattr(UpsertTable, where)

    def killed(self, *a):
        if where == "_write":
            real(self, *a)
        raise InterruptedError
    monkeypatch.setattr(UpsertTable, where, killed)
    with pytest.raises(InterruptedError):
        t.commit(batch(spark, *SECOND), 1)
    assert rows(t.read(), "url", "cnt") == [("a", 1), ("a", 3), ("b", 2)]
    monkeypatch.undo()
    again = table(spark, tmp_path)
    assert again.commit(batch(spark, *SECOND), 1)
    assert rows(again.read(), "window_end", "url", "cnt") == WANT


def test_compact_and_vacuum(spark, tmp_path, monkeypatch):
    t = table(spark, tmp_path)
    t.commit(batch(spark, *FIRST), 0)
    t.commit(batch(spark, *SECOND), 1)
    with monkeypatch.context() as m:        # a compaction that dies changes nothing
        m.setattr(UpsertTable, "_publish", lambda *a: (_ for _ in ()).throw(InterruptedError))
        with pytest.raises(InterruptedError):
            t.compact()
    assert rows(t.read(), "window_end", "url", "cnt") == WANT
    t.compact()
    assert [c.base for c in t.visible()] == [True]
    t.vacuum()
    assert len(list((tmp_path / "t" / "data").iterdir())) == len(list((tmp_path / "t" / "commits").glob("[0-9]*"))) == 1
    assert rows(t.read(), "window_end", "url", "cnt") == WANT
    assert not t.commit(batch(spark, (1, 1, "a", 77)), 1)       # a replay is still known
    t.commit(batch(spark, (1, 1, "a", 10)), 2)
    assert (at(1, 1), "a", 10) in rows(t.read(), "window_end", "url", "cnt")


def test_topn_killed_between_its_tables(spark, tmp_path, monkeypatch):
    """Counts committed, ranking not: the replay ranks the same counts; a window's rows are replaced whole."""
    paths = str(tmp_path / "c"), str(tmp_path / "top")
    sw.upsert_topn(batch(spark, *[(1, 1, f"u{i}", i) for i in range(6)]), 0, *paths, "url", 3)
    more = batch(spark, (1, 1, "u0", 50), (2, 2, "z", 1))
    real = sw.topn_from_counts
    monkeypatch.setattr(sw, "topn_from_counts", lambda *a: (_ for _ in ()).throw(InterruptedError))
    with pytest.raises(InterruptedError):
        sw.upsert_topn(more, 1, *paths, "url", 3)
    monkeypatch.setattr(sw, "topn_from_counts", real)
    sw.upsert_topn(more, 1, *paths, "url", 3)
    top = UpsertTable(spark, paths[1], ("window_end",)).read()
    assert rows(top, "window_end", "rank", "url", "cnt") == [
        (at(1, 1), 1, "u0", 50), (at(1, 1), 2, "u5", 5), (at(1, 1), 3, "u4", 4), (at(2, 2), 1, "z", 1)]


def test_topn_from_old_best_and_batch(spark, tmp_path, monkeypatch):
    """Growing counts over many batches: the ranking equals that of all counts, which are never read again."""
    import random
    rng = random.Random(2)
    paths = str(tmp_path / "c"), str(tmp_path / "top")
    now = {}
    for i in range(5):
        for _ in range(60):
            k = (rng.choice([(1, 1), (1, 2), (2, 0)]), f"u{rng.randrange(25)}")
            now[k] = now.get(k, 0) + rng.randrange(1, 9)
        some = rng.sample(sorted(now), 30) if i < 4 else sorted(now)[:40]
        for k in some:
            now[k] += 1
        sw.upsert_topn(batch(spark, *[(*w, u, now[w, u]) for w, u in (now if i == 0 else some)]), i, *paths, "url", 4)
        if i == 0:
            shown = dict(now)
        else:
            shown.update({k: now[k] for k in some})
        want = []
        for w in sorted({w for w, _ in shown}):
            best = sorted((-n, u) for (x, u), n in shown.items() if x == w)[:4]
            want += [(at(*w), r + 1, u, -n) for r, (n, u) in enumerate(best)]
        top = UpsertTable(spark, paths[1], ("window_end",)).read()
        assert rows(top, "window_end", "rank", "url", "cnt") == sorted(want)
