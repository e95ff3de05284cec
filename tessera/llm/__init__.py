"""Training-data operators: decontamination, deduplication, language, secrets, licences, PII, packing, quality.

Code that runs in Python workers is pickled by value: executors need no copy of this package.
"""

from importlib import import_module

from pyspark import cloudpickle

for _name in ("common", "decontam", "embdedup", "simhash", "langid", "packing", "quality", "sadedup"):
    cloudpickle.register_pickle_by_value(import_module(f"tessera.llm.{_name}"))
