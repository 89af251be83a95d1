"""canopy.sources"""
