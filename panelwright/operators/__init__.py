"""Relational and feature operators."""
