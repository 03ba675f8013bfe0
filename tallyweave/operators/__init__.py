"""Relational operators: facts, rules, queue, metrics, evaluation and audit."""
