"""foliate.functions"""
