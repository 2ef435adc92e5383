"""The per-customer rules alone, on the published unit vectors."""

from tests.naive import DAY, HOUR, WEEK
from tidemark.streaming.behaviour import Behaviour, Session, Txn, may_keep

T0 = 1_700_000_000_000


def spend(behaviour, ms, category, amount, salary=False, card=False):
    return behaviour.observe(ms, Txn(ms, category, round(amount * 100), salary, card))


def test_three_home_categories_fire_once_together():
    b = Behaviour([], None)
    assert spend(b, T0, "home_improvement", 700) == []
    assert spend(b, T0, "furniture", 700) == []
    (signal,) = spend(b, T0, "kitchen_appliances", 700)
    assert (signal.product, signal.pattern, signal.metric) == (
        "home_loan", "home_improvement_session_spend_gt_2000", 2100.0)
    assert b.session is None
    assert b.category_spend() == {"home_improvement": 700.0, "furniture": 700.0, "kitchen_appliances": 700.0}


def test_restored_state_goes_on_where_it_stopped():
    b = Behaviour([], None)
    spend(b, T0, "furniture", 1500)
    again = Behaviour(list(b.txns), b.session)
    assert [s.session_ms for s in spend(again, T0 + HOUR, "furniture", 600)] == [HOUR]
    assert Behaviour([], Session(150000, T0, T0)).observe(T0 + HOUR) == []


def test_burst_needs_three_in_a_day_and_no_card():
    b = Behaviour([], None)
    for hour in (0, 1):
        assert spend(b, T0 + hour * HOUR, "retail", 10) == []
    assert [s.product for s in spend(b, T0 + DAY, "retail", 10)] == ["credit_card"]
    assert spend(b, T0 + DAY + HOUR, "retail", 10, card=True) == []


def test_old_transactions_are_forgotten():
    b = Behaviour([], None)
    spend(b, T0, "travel", 10)
    assert [s.product for s in spend(b, T0 + WEEK, "salary", 10, salary=True)] == ["personal_loan"]
    assert b.observe(T0 + WEEK + 1) == []
    assert b.category_spend() == {"salary": 10.0}


def test_repeat_within_a_day_is_dropped():
    assert may_keep(None, T0)
    assert not may_keep(T0, T0 + DAY - 1)
    assert may_keep(T0, T0 + DAY)
