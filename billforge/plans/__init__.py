"""billforge.plans"""
