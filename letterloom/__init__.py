"""Mail ingestion and text features as Spark DataFrame jobs."""

from letterloom.options import MailOptions

__all__ = ["MailOptions"]
