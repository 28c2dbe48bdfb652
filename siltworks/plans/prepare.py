"""Raw text to features in one call."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from siltworks.config import PrepConfig
from siltworks.operators.clean import clean
from siltworks.operators.features import Fitted, fit, transform
from siltworks.operators.ingest import ingest


@dataclass(frozen=True)
class Prepared:
    """The tables of a preparation; all of them are lazy projections of ``raw``."""

    raw: DataFrame
    clean: DataFrame
    features: DataFrame
    fitted: Fitted


def prepare(text: DataFrame, cfg: PrepConfig, fitted: Fitted | None = None) -> Prepared:
    """Ingest, clean and encode a table of text.

    Only the fit reads the table; give a ``fitted`` from an earlier run to skip it. The
    fit makes a few passes over the numeric and one-hot columns, so hand in a table that
    is cheap to scan (see ``session.stage``).
    """
    raw = ingest(text, cfg)
    fitted = fitted or fit(raw, cfg)
    tidy = clean(raw, cfg, fitted.fences)
    return Prepared(raw, tidy, transform(tidy, cfg, fitted), fitted)
