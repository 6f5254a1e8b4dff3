"""Where the pipelines keep their tables."""

from __future__ import annotations

from dataclasses import dataclass

FEATURE_FEEDS = ["attributes", "financials", "clickstream"]


@dataclass(frozen=True)
class Datamart:
    """Table paths under one root, a local folder or an object store prefix."""

    root: str

    def _at(self, *parts: str) -> str:
        return "/".join([self.root.rstrip("/"), *parts])

    @property
    def loan_bronze(self) -> str:
        return self._at("bronze", "lms")

    def quarantine(self, feed: str) -> str:
        return self._at("bronze", "quarantine", feed)

    @property
    def loan_silver(self) -> str:
        return self._at("silver", "loan_daily")

    @property
    def label_store(self) -> str:
        return self._at("gold", "label_store")

    def feature_bronze(self, feed: str) -> str:
        return self._at("bronze", "features", feed)

    def feature_silver(self, feed: str) -> str:
        return self._at("silver", "features", feed)

    @property
    def feature_store(self) -> str:
        return self._at("gold", "feature_store", "customer")

    @property
    def engagement(self) -> str:
        return self._at("gold", "feature_store", "eng")

    @property
    def risk(self) -> str:
        return self._at("gold", "feature_store", "cust_fin_risk")

    @property
    def joined_features(self) -> str:
        return self._at("gold", "feature_store", "joined")

    @property
    def filled_features(self) -> str:
        return self._at("gold", "feature_store", "filled")

    @property
    def fill_state(self) -> str:
        return self._at("gold", "feature_store", "fill_state")

    @property
    def baselines(self) -> str:
        return self._at("gold", "monitor", "baselines")

    @property
    def ledger(self) -> str:
        return self._at("gold", "ledger")

    @property
    def training_sets(self) -> str:
        return self._at("gold", "training_set")

    @property
    def predictions(self) -> str:
        return self._at("gold", "model_predictions")

    @property
    def monitor(self) -> str:
        return self._at("gold", "monitor", "model_monitor")

    @property
    def training_metrics(self) -> str:
        return self._at("gold", "monitor", "automl_training")

    @property
    def registry(self) -> str:
        return self._at("model_bank", "registry")

    def model(self, name: str) -> str:
        return self._at("model_bank", "models", name)
