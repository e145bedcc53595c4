"""Cancelling queries from another thread."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable

from pyspark.sql import SparkSession

from queryset.errors import CancelledError


class Cancellation:
    """``run`` executes what a program asks of Spark; ``cancel``, from any thread, ends its jobs."""

    def __init__(self, spark: SparkSession):
        self.spark, self.tag, self.cancelled, self.running = spark, f"queryset-{uuid.uuid4().hex}", False, False

    def cancel(self) -> None:
        """Returns when what runs has ended; jobs that start meanwhile are ended as well."""
        self.cancelled = True
        while self.running:
            self.spark.sparkContext.cancelJobGroup(self.tag)
            time.sleep(0.1)

    def run(self, fn: Callable):
        """The result of ``fn``; CancelledError if it was cancelled before or meanwhile. Other errors pass."""
        if self.cancelled:
            raise CancelledError("cancelled before it ran")
        self.spark.sparkContext.setJobGroup(self.tag, "cancellable", True)
        self.running = True
        try:
            return fn()
        except Exception as failed:
            if self.cancelled:
                raise CancelledError("cancelled") from failed
            raise
        finally:
            self.running = False
            for name in ("spark.jobGroup.id", "spark.job.description", "spark.job.interruptOnCancel"):
                self.spark.sparkContext.setLocalProperty(name, None)
