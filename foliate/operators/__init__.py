"""foliate.operators"""
