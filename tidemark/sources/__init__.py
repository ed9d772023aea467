"""Readers and writers: delivery folders, manifests, snapshots, JDBC."""
