"""Loads into a versioned store: commit, repetition, what is new, what is replaced."""

import threading

import pytest
import shop
from conftest import rows

from starmill import schemas
from starmill.plans import increment
from starmill.plans.clean import clean
from starmill.plans.increment import load
from starmill.plans.model import Warehouse
from starmill.sources.store import Conflict, Manifest, Store


@pytest.fixture
def root(tmp_path):
    return str(tmp_path / "dwh")


def everything(store, manifest=None):
    return {t: rows(df) for t, df in store.tables(manifest).items()}


def batch(spark, orders, **more):
    """The shop's clean tables, cut to some of its orders."""
    kept = [o for o in shop.ROWS["orders"] if o[0] in orders]
    return clean(shop.raw(spark, orders=kept, **more))


def test_first_load_equals_the_warehouse_and_a_second_adds_nothing(spark, root):
    first = load(spark, clean(shop.raw(spark)), root, closed="right")
    store = Store(spark, root)
    built = Warehouse(clean(shop.raw(spark)), closed="right")
    before = everything(store)
    for name in schemas.TABLES:
        assert before[name] == rows(schemas.conform(built.table(name), name)), name
        assert schemas.schema_mismatches(store.read(name), name) == []
        assert first.part(name).rows == len(before[name])
    again = load(spark, clean(shop.raw(spark)), root)
    assert again.number == 2 and again.options == {"closed": "right"}
    assert everything(store) == before
    assert {t: p.folders for t, p in again.tables.items()} == {t: p.folders for t, p in first.tables.items()}


def test_half_new_input_keeps_old_keys(spark, root):
    store = Store(spark, root)
    load(spark, batch(spark, ("o2",), customers=shop.ROWS["customers"][1:2]), root, closed="both")
    old = everything(store)
    assert [r[:2] for r in old["dim_customers"]] == [(1, "c2")]
    manifest = load(spark, clean(shop.raw(spark)), root)
    new = everything(store)
    for name in schemas.TABLES:
        assert set(old[name]) <= set(new[name]), name
        keys = [r[0] for r in new[name]]
        assert sorted(keys) == list(range(1, len(keys) + 1)), name
        assert manifest.part(name).next_key == len(keys) + 1
    assert [r[:2] for r in new["dim_customers"]] == [(1, "c2"), (2, "c1"), (3, "c3")]
    # Days before and after the loaded ones get the next keys; the dates of all facts are known.
    days = {r[1]: r[0] for r in new["dim_date"]}
    assert len(days) == 4 and days[old["dim_date"][0][1]] == 1
    whole = Warehouse(clean(shop.raw(spark)), closed="both")
    natural = ["order_id", "order_item_id", "price", "order_purchase_timestamp"]
    assert rows(store.read("fact_orderlifecycle"), *natural) == rows(
        whole.table("fact_orderlifecycle"), *natural
    )
    fact, dates = store.read("fact_orderlifecycle"), store.read("dim_date")
    joined = fact.join(dates, fact.order_purchase_date_sk == dates.date_sk)
    assert joined.where("date = to_date(order_purchase_timestamp)").count() == fact.count()


def test_facts_refer_to_the_right_entities_after_several_loads(spark, root):
    store = Store(spark, root)
    for orders in (("o3",), ("o2", "o3"), ("o1", "o5")):
        load(spark, batch(spark, orders), root, closed="both")
    fact, customers = store.read("fact_orderlifecycle"), store.read("dim_customers")
    found = {(r.order_id, r.customer_id) for r in fact.join(customers, "customer_sk").collect()}
    assert found == {("o1", "c1"), ("o2", "c2"), ("o3", "c3")}
    assert fact.count() == 24
    assert rows(store.read("fact_orderpayments"), "order_id", "payment_sequential", "payment_value") == [
        ("o1", 1, 100.0), ("o1", 2, 26.5), ("o2", 1, 41.0), ("o3", 1, 32.0),
    ]


def test_a_late_review_replaces_the_row_without(spark, root):
    store = Store(spark, root)
    load(spark, batch(spark, ("o2", "o3")), root)
    silent = store.read("fact_orderlifecycle").where("order_id = 'o3'").first()
    assert silent.review_sk is None
    late = [*shop.ROWS["reviews"], ("r9", "o3", "2", None, "late", "2018-02-01", "2018-02-02 10:00:00")]
    manifest = load(spark, batch(spark, ("o3",), reviews=late), root)
    found = store.read("fact_orderlifecycle").where("order_id = 'o3'").collect()
    reviews = {r.review_id: r.review_sk for r in store.read("dim_reviews").collect()}
    assert [(r.review_sk, r.price) for r in found] == [(reviews["r9"], 30.0)]
    assert found[0].order_sk == manifest.part("fact_orderlifecycle").next_key - 1 > silent.order_sk
    assert manifest.part("fact_orderlifecycle").rows == store.read("fact_orderlifecycle").count() == 2
    # The retired row is not loaded again, nor retired twice.
    again = load(spark, batch(spark, ("o3",), reviews=late), root)
    assert again.part("fact_orderlifecycle") == manifest.part("fact_orderlifecycle")


def test_a_changed_order_replaces_its_rows(spark, root):
    store = Store(spark, root)
    load(spark, clean(shop.raw(spark)), root)
    before = store.read("fact_orderlifecycle").where("order_id <> 'o1'")
    kept = rows(before)
    changed = [("o1", "c1", "returned", *o[3:]) for o in shop.ROWS["orders"] if o[0] == "o1"]
    load(spark, clean(shop.raw(spark, orders=changed)), root)
    fact = store.read("fact_orderlifecycle")
    assert {r.order_status for r in fact.where("order_id = 'o1'").collect()} == {"returned"}
    assert fact.where("order_id = 'o1'").count() == 22
    assert rows(fact.where("order_id <> 'o1'")) == kept
    assert store.read("fact_orderpayments").count() == 4


def test_copies_of_an_item_are_loaded_as_often_as_they_occur(spark, root):
    item = ("o1", "1", "p1", "s1", "2018-01-02 12:00:00", "10.0", "1.5")
    store = Store(spark, root)
    sizes = []
    for copies in (1, 3, 2):
        tables = batch(spark, ("o1",), order_items=[item] * copies, reviews=shop.ROWS["reviews"][:1])
        load(spark, tables, root)
        sizes.append(store.read("fact_orderlifecycle").count())
    assert sizes == [1, 3, 3]


@pytest.mark.parametrize("broken", ["dim_reviews", "fact_orderlifecycle"])
def test_a_load_that_dies_changes_nothing(spark, root, monkeypatch, broken):
    store = Store(spark, root)
    load(spark, batch(spark, ("o2",)), root)
    before = everything(store)
    write = Store.write

    def dying(self, df, table, *more):
        if table == broken:
            raise KeyboardInterrupt("killed")
        return write(self, df, table, *more)

    monkeypatch.setattr(Store, "write", dying)
    with pytest.raises(KeyboardInterrupt):
        load(spark, clean(shop.raw(spark)), root)
    assert everything(Store(spark, root)) == before
    monkeypatch.undo()
    assert store.clean_up()  # what the dead load has left
    load(spark, clean(shop.raw(spark)), root)
    assert everything(store)["fact_orderpayments"] != before["fact_orderpayments"]


def test_only_one_of_two_loads_from_the_same_manifest_is_published(spark, root, monkeypatch):
    store = Store(spark, root)
    load(spark, batch(spark, ("o2",)), root)
    publish, other = Store.publish, threading.Event()

    def late(self, manifest):
        if not other.is_set():
            other.set()
            load(spark, batch(spark, ("o3",)), root)
        publish(self, manifest)

    monkeypatch.setattr(Store, "publish", late)
    with pytest.raises(Conflict):
        load(spark, batch(spark, ("o1",)), root)
    assert {r.order_id for r in store.read("fact_orderpayments").collect()} == {"o2", "o3"}


def test_earlier_manifests_stay_readable_until_cleaned_up(spark, root):
    store = Store(spark, root)
    for orders in (("o2",), ("o3",)):
        load(spark, batch(spark, orders), root)
    load(spark, batch(spark, ("o1",)), root, mode="overwrite", closed="both")
    sizes = [store.read("fact_orderpayments", store.manifest(n)).count() for n in (1, 2, 3)]
    assert sizes == [1, 2, 2]
    gone = store.clean_up(keep=1)
    assert len(gone) > len(schemas.TABLES) and store.clean_up(keep=1) == []
    assert store.read("fact_orderpayments").count() == 2
    assert store.manifest().number == 3


def test_empty_store_and_wrong_mode(spark, root):
    store = Store(spark, root)
    assert store.manifest() == Manifest() and store.read("dim_date").count() == 0
    with pytest.raises(ValueError):
        load(spark, clean(shop.raw(spark)), root, mode="merge")
    assert Manifest.parsed(Manifest(3, True, {"closed": "both"}, {"t": increment.Part(("a",), (), 2, 3)}).json()).part(
        "t"
    ) == increment.Part(("a",), (), 2, 3)
