"""Conversation-corpus curation as Spark DataFrame jobs."""
