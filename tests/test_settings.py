from parcelyard import settings


def test_shuffles_are_sized_by_bytes():
    assert settings.shuffle_partitions(0) == 200
    assert settings.shuffle_partitions(10 * 2**40) == 10 * 2**40 // (128 * 2**20)
    assert settings.shuffle_partitions(2**40 + 1) == 2**40 // (128 * 2**20) + 1


def test_settings_are_known_to_the_session(spark):
    for key in settings.SETTINGS:
        assert spark.conf.isModifiable(key), key
