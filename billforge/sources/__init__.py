"""billforge.sources"""
