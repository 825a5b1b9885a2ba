"""strata: a Spark-native medallion analytics library.

bronze (dated deliveries, incremental accumulation) -> silver (unit
conversion, encodings, imputation) -> ML (frequency indexing, random
forest) -> gold (enrichment join, marts) -> serving (stable pages).
"""

__version__ = "0.1.0"
