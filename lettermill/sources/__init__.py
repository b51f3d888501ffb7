"""Mailbox and JSONL sources and sinks."""
