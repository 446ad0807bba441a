"""Readers, writers, plans and fetched inputs."""
