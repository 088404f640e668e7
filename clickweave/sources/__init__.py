"""Readers and writers of click logs, snapshots and vectors."""
