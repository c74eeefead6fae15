"""foliate.sources"""
