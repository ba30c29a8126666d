"""claimlake: layered (bronze / silver / gold) processing of text-heavy tables on Spark.

* ``claimlake.sources``    - landing CSV scan and file stream, rule documents, object files
* ``claimlake.functions``  - pointer, measure, URI and UTF-8 column expressions
* ``claimlake.operators``  - quality checks (registry, annotate, split) and claim-check
                             offload / resolve
* ``claimlake.plans``      - lake tables, ``to_bronze`` / ``to_silver`` / ``to_gold`` / ``run_batch``
* ``claimlake.streaming``  - ``run_stream``: the same layers per micro-batch
"""

__version__ = "0.1.0"
