"""Calendar windows derived from ``as_of`` (pure parameter arithmetic)."""

from datetime import date

import pytest

from partnerkpi.params import FIXTURE_PARAMS, ReportParams


def test_default_windows():
    p = FIXTURE_PARAMS
    assert p.data_end == date(1999, 6, 30)
    assert (p.week_start, p.week_end) == (date(1999, 6, 14), date(1999, 7, 11))
    assert (p.prev_month_start, p.prev_month_end_excl) == (date(1999, 6, 1), date(1999, 7, 1))
    assert p.rolling_start == date(1999, 7, 7)
    assert p.bench_months == 3
    assert p.scorecard_months()[::5] == [("1999-01", "Jan 1999"), ("1999-06", "Jun 1999")]


def test_sunday_excludes_the_running_week():
    p = FIXTURE_PARAMS.with_(as_of=date(1999, 7, 11))
    assert p.week_end == date(1999, 7, 4)
    assert (p.week_end - p.week_start).days == 27
    assert p.week_start.isoweekday() == 1 and p.week_end.isoweekday() == 7


def test_first_of_month_ends_the_day_before():
    p = FIXTURE_PARAMS.with_(as_of=date(1999, 7, 1))
    assert p.data_end == date(1999, 6, 30)
    assert p.prev_month_start == date(1999, 6, 1)
    p2 = FIXTURE_PARAMS.with_(as_of=date(2000, 1, 15))
    assert (p2.prev_month_start, p2.data_end) == (date(1999, 12, 1), date(1999, 12, 31))


def test_severity_cuts():
    assert FIXTURE_PARAMS.severity_cuts(9) == (6, 4)


def test_partner_country_and_dates_have_no_default_and_the_threshold_is_fifty():
    with pytest.raises(TypeError):
        ReportParams()
    p = FIXTURE_PARAMS
    assert ReportParams(p.country, p.partner_group, p.as_of, p.data_start, p.scorecard_start, p.scorecard_end,
                        p.bench_start, p.bench_end).min_month_orders == 50
