import corpus_pipeline
from numberplace import session

from .conftest import SF


def test_a_stage_begins_with_a_collected_driver(spark):
    """What the stage before has left unused in the driver's heap is collected before the next one plans anything."""
    def collections():
        beans = spark._jvm.java.lang.management.ManagementFactory.getGarbageCollectorMXBeans()
        return sum(b.getCollectionCount() for b in beans if "Young" not in b.getName() and "Concurrent" not in b.getName())

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before = collections()
    corpus_pipeline.line_stage(spark, docs, SF)
    assert collections() > before


def test_a_grown_driver_is_collected_when_a_table_is_stored_or_deleted(spark, monkeypatch):
    beans = spark._jvm.java.lang.management.ManagementFactory.getGarbageCollectorMXBeans()

    def collections():
        return sum(b.getCollectionCount() for b in beans if "Old" in b.getName())

    for share, collected in ((0.0, True), (1.1, False)):
        monkeypatch.setattr(session, "HEAP_SHARE", share)
        before = collections()
        table = session.stored(spark.range(3))
        assert (collections() > before) == collected
        before = collections()
        session.discard(table)
        assert (collections() > before) == collected
