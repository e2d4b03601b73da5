"""Features -> segments -> risk -> churn probability -> one customer table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from shelfmark import schemas
from shelfmark.operators import churn
from shelfmark.operators.features import ChurnWindow, churn_dataset, customer_features
from shelfmark.operators.rfm import rfm_scores
from shelfmark.operators.risk import RiskLimits, risk_scores
from shelfmark.session import durable
from shelfmark.sources.adapter import Tables


def scored_customers(t: Tables, limits: RiskLimits = RiskLimits(), **features) -> DataFrame:
    """Every customer with features, segment and risk, as of the latest order.

    The features are made durable: ranks and scores both read them.
    """
    base = durable(customer_features(t.orders, t.customers, t.products, **features))
    return risk_scores(rfm_scores(base), limits)


@dataclass(frozen=True)
class ChurnPlan:
    """Train on an earlier cutoff, evaluate on a later one."""

    train: ChurnWindow
    test: ChurnWindow

    def datasets(self, t: Tables) -> tuple[DataFrame, DataFrame]:
        return tuple(
            churn_dataset(t.orders, t.customers, t.products, w) for w in (self.train, self.test)
        )

    def fit(self, t: Tables) -> tuple[churn.ChurnModels, DataFrame]:
        """Fitted models and the held-out test rows."""
        train, test = self.datasets(t)
        models = churn.fit_models(churn.training_rows(train))
        return models, churn.training_rows(test)


def customer_analytics(scored: DataFrame, probabilities: DataFrame) -> DataFrame:
    """The unified customer table in its published column order."""
    joined = scored.join(probabilities, "customer_id")
    return joined.select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in schemas.CUSTOMER_ANALYTICS]
    )
