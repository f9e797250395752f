"""Inputs, snapshots, model tables and sinks."""
