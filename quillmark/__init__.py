"""Quillmark: text-corpus analytics written as Spark DataFrame jobs.

Every function takes DataFrames or Columns and returns them; the caller owns the session
and its settings.
"""
