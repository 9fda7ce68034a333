"""Named analytics: compositions of the operators with published defaults.

Inputs are canonical frames (see :mod:`reviewlens.schemas`); item-grain
analytics take the shared item summary, so several can use one pass over the
fact.
"""
