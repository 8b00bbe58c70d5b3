from collections import defaultdict
from datetime import date, timedelta

import pytest
from builders import months, payments, random_ledger, statements

from conftest import rows_of
from ledgerfeat.operators import payments as pm
from ledgerfeat.operators.skew import NONE, HotKeys
from ledgerfeat.operators.statements import enrich_statements


def paid(spark, stm, pay):
    enriched = enrich_statements(statements(spark, stm))
    return {r.statement_id: r for r in pm.pct_paid(enriched, payments(spark, pay)).collect()}


def outcomes(spark, stm, pay):
    enriched = enrich_statements(statements(spark, stm))
    return {r.statement_id: r for r in pm.bill_outcomes(enriched, payments(spark, pay)).collect()}


def test_zero_balance_and_overpaid_count_as_one(spark):
    out = paid(spark, months(1, 1, total=0) + months(2, 1, first_id=2), [(2, date(2017, 1, 20), 120)])
    assert out[1].pct_paid == 1.0 and out[1].paid_until_next == 0
    assert out[2].pct_paid == 1.0 and out[2].paid_until_next == 120


def test_payment_on_statement_day_belongs_to_it(spark):
    out = paid(spark, months(1, 2), [(1, date(2017, 1, 15), 30), (1, date(2017, 2, 15), 50)])
    assert out[1].pct_paid == 0.3 and out[2].pct_paid == 0.5


def test_unpaid_bill_caps_at_own_worst_or_open_days(spark):
    out = outcomes(spark, months(1, 2), [(1, date(2017, 2, 1), 40)])
    assert out[1].next_delay == 17 and out[1].full_delay is None
    assert out[1].full_delay_capped == 31 + 60
    assert out[2].next_delay is None and out[2].next_delay_capped == 60


def test_own_worst_delay_beats_open_days(spark):
    stm = [(1, 1, date(2017, 1, 1), 100, 0, 1000, 0), (1, 2, date(2017, 9, 1), 100, 0, 1000, 0)]
    out = outcomes(spark, stm, [(1, date(2017, 8, 1), 100)])
    assert out[1].next_delay == 212 and out[2].next_delay_capped == 212


def test_two_part_payments(spark):
    row = outcomes(spark, months(1, 1), [(1, date(2017, 1, 20), 40), (1, date(2017, 1, 25), 60)])[1]
    assert row.next_payment_date == date(2017, 1, 20) and row.full_payment_date == date(2017, 1, 25)


def test_reversed_amounts_do_not_hide_an_earlier_full_payment(spark):
    pay = [(1, date(2017, 1, 16), 110), (1, date(2017, 1, 17), -60), (1, date(2017, 1, 18), 20)]
    assert outcomes(spark, months(1, 1), pay)[1].full_payment_date == date(2017, 1, 16)


def test_peak_before_the_statement_does_not_pay_it(spark):
    stm = [(1, 1, date(2017, 3, 1), 100, 0, 1000, 0), (1, 2, date(2017, 4, 1), 30, 0, 1000, 0)]
    pay = [(1, date(2017, 1, 1), 500), (1, date(2017, 2, 1), -450), (1, date(2017, 3, 2), 60), (1, date(2017, 3, 9), 60),
           (1, date(2017, 4, 2), -20), (1, date(2017, 4, 3), 50)]
    out = outcomes(spark, stm, pay)
    assert out[1].next_payment_date == date(2017, 3, 2) and out[1].full_payment_date == date(2017, 3, 9)
    assert out[2].full_payment_date == date(2017, 4, 3)


def test_payment_without_amount(spark):
    pay = [(1, date(2017, 1, 2), None), (1, date(2017, 1, 20), 40), (1, date(2017, 1, 25), 60)]
    assert outcomes(spark, months(1, 1), pay)[1].full_payment_date == date(2017, 1, 25)


def test_long_calendar_is_searched(spark):
    days = [date(1990, 1, 1) + timedelta(i) for i in range(9000)]
    stm = [(1, i, days[i], 25, 0, 1000, 0) for i in range(0, 8900, 13)]
    out = outcomes(spark, stm, [(1, d, 1) for d in days])
    assert all(r.full_payment_date == days[i + 24] and r.next_payment_date == days[i] for i, r in out.items())


def test_never_paid_account(spark):
    row = outcomes(spark, months(1, 1), [])[1]
    assert row.next_delay is None and row.full_delay_capped == 60


@pytest.mark.parametrize("hot", [NONE, HotKeys((1,)), HotKeys(every=True)])
@pytest.mark.parametrize("negative", [False, True])
def test_against_brute_force(spark, hot, negative):
    ledger = random_ledger(spark, seed=3, negative=negative)
    enriched = enrich_statements(ledger.statements)
    by_account = defaultdict(list)
    for p in ledger.payments.collect():
        by_account[p.account_id].append((p.paid_at.date(), p.amount))
    stm = enriched.collect()
    got_paid = {r.statement_id: r for r in pm.pct_paid(enriched, ledger.payments, hot).collect()}
    got_bill = {r.statement_id: r for r in pm.bill_outcomes(enriched, ledger.payments, hot).collect()}
    got_after = {r.statement_id: r for r in pm.payments_after(enriched, ledger.payments, hot).collect()}
    assert len(got_paid) == len(stm) and len(got_bill) == sum(s.total_balance > 0 for s in stm)
    for s in stm:
        after = sorted(x for x in by_account[s.account_id] if x[0] >= s.statement_date)
        until = sum(x for d, x in after if d < s.next_statement_date)
        assert got_paid[s.statement_id].paid_until_next == pytest.approx(float(until))
        assert got_after[s.statement_id].payment_days == len({d for d, _ in after})
        assert got_after[s.statement_id].amount_after == pytest.approx(float(sum(x for _, x in after)))
        if s.total_balance > 0:
            daily, total, full = defaultdict(int), 0, None
            for d, x in after:
                daily[d] += x
            for d in sorted(daily):
                total += daily[d]
                if total >= s.total_balance:
                    full = d
                    break
            assert got_bill[s.statement_id].next_payment_date == (after[0][0] if after else None)
            assert got_bill[s.statement_id].full_payment_date == full


def test_running_paid_grows_with_positive_amounts(spark):
    ledger = random_ledger(spark)
    last = {}
    for r in sorted(pm.running_paid(ledger.payments).collect(), key=lambda r: (r.account_id, r.day)):
        assert r.paid_so_far > last.get(r.account_id, 0)
        last[r.account_id] = r.paid_so_far


def test_monthly_totals_weighted_and_even(spark):
    pay = payments(spark, [(1, date(2017, 1, 1), 10), (1, date(2017, 1, 9), 20), (1, date(2017, 2, 1), 60)])
    weighted, even = pm.payments_monthly(pay).first(), pm.payments_monthly(pay, per_payment=False).first()
    assert (weighted.count_monthly_payments, weighted.mean_monthly_payment) == (3, 40.0)
    assert (even.count_monthly_payments, even.mean_monthly_payment) == (2, 45.0)
    assert weighted.last_monthly_payment == 60 and weighted.min_monthly_payment == 30


def test_full_payers(spark):
    enriched = enrich_statements(statements(spark, months(1, 1) + months(2, 1, first_id=2)))
    out = pm.bill_outcomes(enriched, payments(spark, [(1, date(2017, 1, 15) + timedelta(3), 100)]))
    assert rows_of(pm.full_payers(out)) == [(1, 1)]
