"""The keyed state of the decision stream, without a stream: pages against a plain dict, the rules against a plain replay,
and how often a call asks the store."""

import json
import random
from types import SimpleNamespace

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from stockroom.streaming import decisions as SD


class Store:
    """What a key's state variables hold, with a count of the calls."""

    def __init__(self):
        self.held, self.calls = {}, 0

    def variable(self, name):
        def call(f):
            def counted(*a):
                self.calls += 1
                return f(*a)
            return counted
        held = self.held.setdefault(name, {})
        return SimpleNamespace(
            exists=call(lambda: () in held), get=call(lambda: held[()]), update=call(lambda v: held.update({(): v})),
            getValue=call(lambda k: held[k]), updateValue=call(lambda k, v: held.update({k: v})),
            containsKey=call(lambda k: k in held), removeKey=call(lambda k: held.pop(k)), values=call(lambda: [*held.values()]))

    def getValueState(self, name, schema):
        return self.variable(name)

    def getMapState(self, name, key_schema, schema):
        return self.variable(name)


def _row(id, target=None, expected=None, ts="2024-01-01T00:00:00.000001"):
    fields = {"ts": ts, "dept": "Wine", "item": "Ale", "action": "qty", "qty": id % 7}
    line = ",".join("" if x is None else str(x) for x in (id, target, expected)) + "," + json.dumps(fields)
    return Row(dept_key="wine", item_key="ale", line=line)


def _run(store, rows):
    state = SD.KeyState()
    state.init(store)
    return [(r["kind"], r["id"], r["target_id"]) for r in state.handleInputRows(("wine", "ale"), iter(rows), None)]


def _plain(held, rows):
    """The same rules, entry by entry."""
    entries, undone = held
    said, before = [], max(entries, default=None)
    for id, target, expected in sorted(rows):
        top = max(entries, default=None)
        if id in entries:
            continue
        if expected is not None and expected != (-1 if top is None else top):
            said.append(("conflict", id, target))
            continue
        if target is not None and target in undone:
            if undone[target] <= id:
                said.append(("refused", id, target))
                continue
            entries.discard(undone[target])
            said.append(("refused", undone[target], target))
        if target is not None:
            undone[target] = id
        entries.add(id)
        if expected is not None:
            said.append(("accepted", id, target))
    if entries and max(entries) != before:
        said.append(("state", max(entries), None))
    return said


@pytest.mark.parametrize("seed", range(12))
def test_the_rules_equal_a_plain_replay(monkeypatch, seed):
    """Entries in any order, in many calls, some twice, with undos of old and new targets and stale ``expected``."""
    monkeypatch.setattr(SD, "PAGE", 1 + seed % 4)
    draw, store, held = random.Random(seed), Store(), (set(), {})
    sets = draw.sample(range(0, 4000, 2), 120)
    log = [(i, None, None) for i in sets]
    log += [(i, draw.choice(sets), None) for i in draw.sample(range(1, 4000, 2), 80)]
    if seed % 3:
        draw.shuffle(log)
    else:
        log.sort()
    log += draw.sample(log, 30)
    while log:
        n = draw.choice([1, 2, 9, 40])
        part, log = log[:n], log[n:]
        part = [(i, t, draw.choice([None, None, None, max(held[0], default=-1), 3])) for i, t, _ in dict((x[0], x) for x in part).values()]
        assert _run(store, [_row(i, t, e) for i, t, e in part]) == _plain(held, part)
        if held[0]:
            assert store.held["newest"][()][0] == max(held[0])


@pytest.mark.parametrize("order", ["ascending", "shuffled"])
def test_pages_hold_what_a_dict_holds(monkeypatch, order):
    monkeypatch.setattr(SD, "PAGE", 4)
    keys = list(range(-50, 250))
    if order == "shuffled":
        random.Random(1).shuffle(keys)
    store, plain, index, inline = Store(), {}, [], b""
    pages = store.variable("pages")
    for at in range(0, len(keys), 11):
        held = SD.Paged(pages, index, inline, SD._ids_in, SD._ids_out)
        for k in keys[at:at + 11]:
            held[k] = None
            plain[k] = None
        for k in keys[max(0, at - 20):at:9]:
            assert k in held
            del held[k]
            del plain[k]
        index, inline = held.stored()
        assert all((k in SD.Paged(pages, index, inline, SD._ids_in, SD._ids_out)) == (k in plain) for k in range(-60, 260))
    assert len(SD._ids_in(inline)) <= 8 and all(len(SD._ids_in(v[0])) <= 8 for v in store.held["pages"].values())
    assert [b for b, _ in index] == sorted(b for b, _ in index) and len({n for _, n in index}) == len(index)


def test_a_call_asks_the_store_by_pages_not_by_entries():
    store = Store()
    _run(store, [_row(i, i - 1 if i % 5 == 4 else None) for i in range(5000)])
    many = store.calls
    assert many <= 3 + 6 * 5000 / SD.PAGE
    store.calls = 0
    said = _run(store, [_row(i, i - 1 if i % 5 == 4 else None) for i in range(5000, 5060)] + [_row(9, 8)])
    assert said == [("state", 5059, None)] and store.calls <= 10


def test_packed_fields_come_back_as_they_were(spark):
    """Microseconds, texts with commas and quotes, empty texts and nulls go through the packed lines."""
    import datetime
    rows = [(1, datetime.datetime(2024, 2, 29, 23, 59, 59, 1), ' "Wine", Beer ', "a,b\nc\\", "qty", -5, "", None, None, None, None, None),
            (2, None, "", "ü   x", "fix", None, "note", None, None, None, None, -1),
            (3, datetime.datetime(1969, 1, 1), None, None, "skip", None, None, None, None, None, None, None),
            (4, datetime.datetime(2024, 1, 1), "Wine", "x", "undo", None, None, 1, "qty", 7, None, 3)]
    lines = {r["line"].split(",")[0]: r for r in SD.routed(spark.createDataFrame(rows, SD.INPUT_SCHEMA)).collect()}
    assert len(lines) == 4
    for r in rows[:3]:
        id, target, expected, packed = SD.unpacked(lines[str(r[0])]["line"])
        assert SD.whole((id, packed)) == r[:7] and (target, expected) == (None, r[-1])
    id, target, expected, packed = SD.unpacked(lines["4"]["line"])
    assert (target, expected) == (1, 3) and SD.whole((4, packed)) == (4, rows[3][1], *rows[0][2:4], None, None, None)
    assert [lines[k]["item_key"] for k in "123"] == ["a,b\nc\\", "ü   x", None]


def test_the_state_has_its_own_partitions(spark, tmp_path):
    src, feed, ck = (str(tmp_path / x) for x in ("src", "feed", "ck"))
    was = {k: spark.conf.get(k, None) for k in [*SD.STATE_CONF, "spark.sql.shuffle.partitions"]}
    for k in range(2):
        log = spark.range(200 * k, 200 * k + 200).select("id", F.lit(None).cast("timestamp_ntz").alias("ts"), F.lit("Wine").alias("dept"),
                                                         F.concat(F.lit("item "), F.col("id") % 20).alias("item"), F.lit("qty").alias("action"))
        log.coalesce(1).write.mode("append").parquet(src)
        SD.start(spark, src, feed, ck, partitions=3 + k).awaitTermination()
        assert {x: spark.conf.get(x, None) for x in was} == was
    state = spark.read.format("state-metadata").load(ck)
    assert {r["numPartitions"] for r in state.collect()} == {3}
    assert {r["set_by"] for r in SD.read_state(spark, ck).collect()} == set(range(380, 400))
