"""Of two runs of one name at a time one stops before it writes."""

from concurrent.futures import ThreadPoolExecutor
from threading import Barrier

import pytest

from rosterlake.plans import daily_load as P
from rosterlake.sinks.claims import Claim, ClaimLost, claimed


def test_one_of_many_wins(spark, tmp_path):
    path, start = str(tmp_path / "claims" / "run"), Barrier(8)

    def attempt(k):
        start.wait()
        try:
            Claim(spark, path, f"attempt-{k}").make()
        except ClaimLost:
            return 0
        return 1

    with ThreadPoolExecutor(8) as pool:
        assert sum(pool.map(attempt, range(8))) == 1


def test_released_taken_over_and_fenced(spark, tmp_path):
    path = str(tmp_path / "run")
    with claimed(spark, path, "one") as one:
        with pytest.raises(ClaimLost, match="held by one"):
            with claimed(spark, path, "two"):
                pass
        # The loser left the winner's claim alone.
        one.require()
        with claimed(spark, path, "three", take_over=True):
            with pytest.raises(ClaimLost, match="held by three"):
                one.require()
    assert one.holder() is None
    with pytest.raises(ZeroDivisionError):
        with claimed(spark, path, "four"):
            1 / 0
    assert one.holder() is None


def test_second_run_writes_nothing(spark, tmp_path):
    house = P.Warehouse(str(tmp_path / "house"))
    with claimed(spark, f"{house.path('ledger', 'claims')}/20240101", "other"):
        with pytest.raises(ClaimLost):
            P.run_day(spark, str(tmp_path / "in"), house, {}, "20240101", "2024-01-01")
    assert [p.name for p in (tmp_path / "house").iterdir()] == ["ledger"]
    assert [p.name for p in (tmp_path / "house" / "ledger").iterdir()] == ["claims"]
