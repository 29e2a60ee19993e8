"""Parameterised Spark jobs: geo marts, payouts, warehouse loads, experiments, training."""
