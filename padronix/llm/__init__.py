"""Operators for preparing training text: near copies, decontamination, personal data, quality, mixing, output."""
