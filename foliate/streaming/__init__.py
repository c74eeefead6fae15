"""foliate.streaming"""
