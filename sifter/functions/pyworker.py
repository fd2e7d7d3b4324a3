"""Make Python UDF code importable on executors without installing the package.

Modules holding UDF bodies are pickled by value, so a cluster only needs
pandas/pyarrow (and optionally pyahocorasick) on its Python workers.
"""

from __future__ import annotations

import sys

_done: set[str] = set()


def ship_by_value(module_name: str) -> None:
    if module_name in _done:
        return
    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(sys.modules[module_name])
    _done.add(module_name)
