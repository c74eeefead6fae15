"""foliate.plans"""
