"""canopy.streaming"""
