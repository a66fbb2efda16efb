"""The build lock: live, dead, watched and lost owners."""

import os
import threading
import time

import pytest

from lakestar.plans import lease


def _age(path, seconds):
    then = time.time() - seconds
    os.utime(path, (then, then))


def test_an_old_but_live_lock_refuses(spark, tmp_path):
    path = str(tmp_path / "LOCK")
    with lease.held(spark, path, 1.5) as owner:
        time.sleep(2)  # longer than the lease: the beats keep it
        _age(path, 30 * 86400)
        owner.check()
        with pytest.raises(lease.LockHeld, match="another build"):
            lease.Lease(spark, path, 1.5).acquire()
        owner.check()
    assert list(tmp_path.glob("LOCK*")) == []


def test_a_dead_lock_is_taken_over(spark, tmp_path):
    path = tmp_path / "LOCK"
    path.write_text("gone")
    (tmp_path / "LOCK.gone").write_text("1")
    _age(tmp_path / "LOCK.gone", 3600)
    began = time.time()
    with lease.held(spark, str(path), 0.6) as owner:
        assert time.time() - began >= 0.6  # it was watched for a lease
        assert path.read_text() == owner.token
        owner.check()
    assert list(tmp_path.glob("LOCK*")) == []


def test_a_lock_without_beat_is_watched_before_it_is_taken(spark, tmp_path):
    path = tmp_path / "LOCK"
    path.write_text("")  # a build died while it created the lock
    _age(path, 3600)
    with lease.held(spark, str(path), 0.5) as owner:
        owner.check()


def test_a_beat_that_moves_while_watched_refuses(spark, tmp_path):
    path, beat = tmp_path / "LOCK", tmp_path / "LOCK.slow"
    path.write_text("slow")
    beat.write_text("1")
    _age(beat, 3600)  # a clock far behind the store's, say
    mover = threading.Timer(0.4, lambda: _age(beat, 3500))
    mover.start()
    with pytest.raises(lease.LockHeld):
        lease.Lease(spark, str(path), 1.5).acquire()
    mover.join()
    assert path.read_text() == "slow"


def test_one_of_several_contenders_wins(spark, tmp_path):
    path = tmp_path / "LOCK"
    path.write_text("gone")
    won, refused = [], []

    def contend():
        mine = lease.Lease(spark, str(path), 0.6)
        try:
            mine.acquire()
            won.append(mine)
        except lease.LockHeld:
            refused.append(mine)

    threads = [threading.Thread(target=contend) for _ in range(4)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert len(won) == 1 and len(refused) == 3 and path.read_text() == won[0].token
    won[0].check()
    won[0].release()


def test_a_lost_lock_is_noticed_and_left_alone(spark, tmp_path):
    path = tmp_path / "LOCK"
    owner = lease.Lease(spark, str(path), 5)
    owner.acquire()
    path.write_text("someone else")
    with pytest.raises(lease.LockHeld, match="lost"):
        owner.check()
    owner.release()
    assert path.read_text() == "someone else"


def test_without_beats_the_lock_may_be_lost(spark, tmp_path, monkeypatch):
    owner = lease.Lease(spark, str(tmp_path / "LOCK"), 0.6)
    owner.acquire()
    monkeypatch.setattr(owner, "_beat", lambda: None)  # the store does not answer
    time.sleep(0.8)
    with pytest.raises(lease.LockHeld):
        owner.check()
    owner.release()
