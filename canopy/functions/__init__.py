"""canopy.functions"""
