from __future__ import annotations

from tillstar.session import SETTINGS, session, shuffle_partitions


def test_settings_apply_to_the_running_session(spark, restored_settings):
    key = "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold"
    assert session(settings={key: "1m"}).conf.get(key) == "1m"
    assert session().conf.get(key) == SETTINGS[key]


def test_shuffle_partitions():
    assert shuffle_partitions(0, 8) == 8
    assert shuffle_partitions(40 << 40, 8000) == 327_680


def test_shuffles_are_sized_by_what_is_stored(spark, tmp_path, monkeypatch):
    from tillstar import session

    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    (tmp_path / "a").write_bytes(b"x" * 3000)
    (tmp_path / "b").mkdir()
    (tmp_path / "b" / "c").write_bytes(b"x" * 500)
    assert session.stored_bytes(spark, f"{tmp_path}/a", f"{tmp_path}/b", f"{tmp_path}/nowhere") == 3500
    with session.sized_shuffles(spark, str(tmp_path)):
        assert spark.conf.get(key) == before  # never fewer than the session has
    monkeypatch.setattr(session, "SHUFFLED_PER_STORED", 1 << 20)
    with session.sized_shuffles(spark, str(tmp_path)):
        assert int(spark.conf.get(key)) == -(-3500 * (1 << 20) // (128 << 20))
    assert spark.conf.get(key) == before
