"""Incremental loads."""

from .incremental import PullLoad, close_pull, merge_stream, retry_set_aside, start_feed_stream
from .pulls import pull_outcomes, set_aside_pulls

__all__ = [
    "PullLoad",
    "close_pull",
    "merge_stream",
    "pull_outcomes",
    "retry_set_aside",
    "set_aside_pulls",
    "start_feed_stream",
]
