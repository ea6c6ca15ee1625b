"""Readers and writers of clause stores, snapshots, logs and documents."""
