"""Every analysis by name, for the command line, the benchmark and the tests."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from salestide.functions import labels
from salestide.operators.customers import customer_totals
from salestide.operators.products import yearly_product_sales
from salestide.plans import cumulative, performance, reports, segments, shares, trends
from salestide.sources.star import Star


@dataclass(frozen=True)
class Options:
    """``as_of`` is the day ages and recency refer to; ``None`` means the current date."""

    as_of: str | None = None
    spend_limit: int = labels.SPEND_LIMIT
    tenure_days: int = labels.TENURE_DAYS
    tenure_months: int = labels.TENURE_MONTHS

    @property
    def by_days(self) -> dict:
        return {"spend_limit": self.spend_limit, "tenure_days": self.tenure_days}

    @property
    def by_months(self) -> dict:
        return {"spend_limit": self.spend_limit, "tenure_months": self.tenure_months}


def _report(star: Star, opt: Options) -> DataFrame:
    return reports.report(star.sales, star.customers, opt.as_of, **opt.by_months)


Analysis = Callable[[Star, Options], DataFrame]

ANALYSES: dict[str, Analysis] = {
    "trend_order_lines": lambda s, o: trends.order_lines(s.sales),
    "trend_daily": lambda s, o: trends.daily(s.sales),
    "trend_yearly": lambda s, o: trends.yearly(s.sales),
    "trend_month_of_year": lambda s, o: trends.month_of_year(s.sales),
    "trend_year_month": lambda s, o: trends.year_month(s.sales),
    "trend_month_start": lambda s, o: trends.month_start(s.sales),
    "cum_month_of_year": lambda s, o: cumulative.month_of_year(s.sales),
    "cum_month_totals": lambda s, o: cumulative.month_totals(s.sales),
    "cum_running_month": lambda s, o: cumulative.running_by_month(s.sales),
    "cum_ytd_month": lambda s, o: cumulative.year_to_date(s.sales),
    "cum_running_year": lambda s, o: cumulative.running_by_year(s.sales),
    "cum_year_avg_price": lambda s, o: cumulative.yearly_mean_price(s.sales),
    "cum_running_year_avg_price": lambda s, o: cumulative.running_with_mean_price(s.sales),
    "seg_product_cost_range": lambda s, o: segments.product_cost_ranges(s.products),
    "seg_product_cost_range_counts": lambda s, o: segments.product_cost_range_counts(s.products),
    "seg_customer_spending": lambda s, o: segments.customer_spending(s.sales, s.customers),
    "seg_customer_detail": lambda s, o: segments.customer_detail(s.sales, s.customers, **o.by_days),
    "seg_customer_labels": lambda s, o: segments.customer_labels(s.sales, s.customers, **o.by_days),
    "seg_customer_counts": lambda s, o: segments.customer_counts(s.sales, s.customers, **o.by_days),
    "share_by_category": lambda s, o: shares.by_category(s.sales, s.products),
    "perf_yearly_product": lambda s, o: yearly_product_sales(s.sales, s.products),
    "perf_vs_avg": lambda s, o: performance.mean(s.sales, s.products),
    "perf_vs_avg_diff": lambda s, o: performance.mean_difference(s.sales, s.products),
    "perf_vs_avg_label": lambda s, o: performance.mean_label(s.sales, s.products),
    "perf_prev_year": lambda s, o: performance.previous_year(s.sales, s.products),
    "perf_yoy": lambda s, o: performance.year_on_year(s.sales, s.products),
    "report_base": lambda s, o: reports.base(s.sales, s.customers, o.as_of),
    "report_customer_agg": lambda s, o: customer_totals(s.sales, s.customers, o.as_of),
    "report_customer": _report,
    "report_top_customers": lambda s, o: reports.top_customers(_report(s, o)),
}

# The only analyses that read the price column.
READ_PRICE = {"cum_year_avg_price", "cum_running_year_avg_price"}
