"""tidemark: payment-fraud features, models and monitoring as Spark jobs.

The name is the idea: a label only counts once the tide has passed it. Every
feature is computed from rows that were already known (and, for labels,
already settled) at the instant of the transaction.
"""
