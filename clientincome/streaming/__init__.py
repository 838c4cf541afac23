"""Streaming: intentionally empty.

The original pipeline is a monthly batch job: it has no stream sources,
watermarks, time windows or state (its only trace of streaming is an unused
shutdown setting).  Its work is re-expressed as batch DataFrame plans in
``clientincome.plans``; nothing is added here that it does not do.
"""
