"""ledgerline: corporate financial modelling as PySpark DataFrame transformations.

Every operator is a lazy ``DataFrame -> DataFrame`` function keyed by
``company``.  Actions happen only where a layer table is written or the quality
gate has to decide whether a run may go on.
"""

__version__ = "0.1.0"
