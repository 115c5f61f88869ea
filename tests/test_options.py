import pytest

from stowage import Conditions, ReadOptions, WriteOptions


def test_defaults():
    read, write = ReadOptions("parcels"), WriteOptions("parcels")
    assert (read.space, read.cursor_batch_size, read.batch_size) == ("parcels", 1000, 1000)
    assert read.conditions == Conditions.any()
    assert (write.batch_size, write.stop_on_error, write.rollback_on_error) == (1000, True, True)
    assert write.transform_field_names == "none"


def test_conditions_are_copied():
    read = ReadOptions("parcels")
    more = read.with_conditions(Conditions.index_greater_than(0, [1]))
    assert more.conditions == Conditions.index_greater_than(0, [1])
    assert read.conditions == Conditions.any()


def test_missing_space(spark, store):
    with pytest.raises(ValueError, match="no space was named"):
        ReadOptions.resolve(spark)
    with pytest.raises(ValueError, match="no space was named"):
        store.write(spark.range(1))
    with pytest.raises(ValueError, match="no space was named"):
        store.scan()


def test_priority(spark):
    call = {"stowage.space": "parcels", "stowage.batchSize": "10"}
    try:
        spark.conf.set("stowage.batchSize", "20")
        assert WriteOptions.resolve(spark, call).batch_size == 10
        assert WriteOptions.resolve(spark, call, batch_size=5).batch_size == 5
        assert WriteOptions.resolve(spark, {"stowage.space": "parcels"}).batch_size == 20
        assert WriteOptions.resolve(spark, {"spark.stowage.space": "parcels"}).space == "parcels"
        spark.conf.set("stowage.space", "other")
        assert WriteOptions.resolve(spark).space == "other"
        assert WriteOptions.resolve(spark, call).space == "parcels"
    finally:
        spark.conf.unset("stowage.batchSize")
        spark.conf.unset("stowage.space")
    assert WriteOptions.resolve(spark, {"stowage.space": "parcels"}).batch_size == 1000


def test_values():
    call = {"stowage.space": "s", "stowage.stopOnError": "FALSE", "stowage.transformFieldNames": "Snake_Case"}
    write = WriteOptions.resolve(None, call)
    assert write.stop_on_error is False and write.transform_field_names == "snake_case"
    for wrong in ({"stowage.batchSize": "0"}, {"stowage.stopOnError": "yes"}, {"stowage.transformFieldNames": "x"}):
        with pytest.raises(ValueError):
            WriteOptions.resolve(None, {"stowage.space": "s", **wrong})
    with pytest.raises(TypeError, match="unknown options"):
        WriteOptions.resolve(None, None, space="s", colour="red")
