"""Whole-query compositions: batch settlement, serving queries, reports."""
