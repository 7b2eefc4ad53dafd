"""The score stage as a Spark ML ``Transformer`` (N2-N7 with stored bounds).

Bounds (A7) and the global maximum (A9) fitted on training data are kept as
params, so ``Pipeline([ScoreTransformer(...), assembler, classifier])`` is
saved and loaded as one ``PipelineModel`` and new invoices are scored with the
training-time normalisation. The transform is column arithmetic only.
"""

from __future__ import annotations

import datetime as dt
import json

from pyspark import keyword_only
from pyspark.ml import Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame

from ..params import ScoreParams
from .scoring import add_component_scores, finish_scores, with_bounds


def _encode(bounds: dict) -> str:
    return json.dumps({k: (v.isoformat() if isinstance(v, dt.date) else v) for k, v in bounds.items()})


def _decode(text: str) -> dict:
    out = {}
    for k, v in json.loads(text).items():
        out[k] = dt.date.fromisoformat(v) if k.endswith("_invoice_date") and v is not None else v
    return out


class ScoreTransformer(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Adds the five scores (-1 when unscorable) and ``is_scorable`` to feature rows."""

    bounds = Param(Params._dummy(), "bounds", "JSON of the min/max bounds fitted on training data",
                   typeConverter=TypeConverters.toString)
    gMax = Param(Params._dummy(), "gMax", "maximum combined score over scorable training rows",
                 typeConverter=TypeConverters.toFloat)

    @keyword_only
    def __init__(self, bounds: str | None = None, gMax: float | None = None):
        super().__init__()
        kwargs = self._input_kwargs
        self._set(**{k: v for k, v in kwargs.items() if v is not None})

    @staticmethod
    def from_context(bounds: dict, g_max: float) -> "ScoreTransformer":
        return ScoreTransformer(bounds=_encode(bounds), gMax=float(g_max))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        params = ScoreParams()
        scored = add_component_scores(with_bounds(dataset, _decode(self.getOrDefault(self.bounds))), params)
        return finish_scores(scored, self.getOrDefault(self.gMax), params)
