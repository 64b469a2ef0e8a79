"""Operators for training-data corpora."""

import os
import site
import sys
from pathlib import Path

from pyspark import cloudpickle

# Workers that cannot import the package get its functions by value.
_ROOT = Path(__file__).resolve().parents[2]
_REACHED = [*os.environ.get("PYTHONPATH", "").split(os.pathsep), *site.getsitepackages(), os.getcwd()]
if _ROOT not in {Path(p).resolve() for p in _REACHED if p}:
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
