"""tontine: life-liability projection and valuation expressed as Spark DataFrame plans.

Layers (each a plain function DataFrame -> DataFrame, nothing runs until an action):

* ``sources``   raw-table schemas, assumption generators/loaders, driver-table adapters, sinks
* ``functions`` column-expression helpers (rates, curve brackets, discount factors)
* ``operators`` staging, projection, cash flows, discounting, valuation, pricing,
                curve analytics, validation gate, data-quality runner, reports
* ``plans``     wiring: the model-point row path, the seriatim unit-factor path,
                the query registry used by ``__spark_entry__``
"""

from tontine.params import ValuationParams

__all__ = ["ValuationParams"]
