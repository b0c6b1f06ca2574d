"""Composed jobs (snapshot build, evaluation, training, scoring) and oracles."""
