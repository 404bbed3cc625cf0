"""Operators of a training-data pipeline: filtering, near duplicates, decontamination and mixing."""
