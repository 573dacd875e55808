"""Hand-made customers. The ten sample customers and the four raw ones."""

SAMPLE = """\
customer_id,gender,senior_citizen,partner,dependents,tenure,phone_service,multiple_lines,internet_service,online_security,online_backup,device_protection,tech_support,streaming_tv,streaming_movies,contract,paperless_billing,payment_method,monthly_charges,total_charges,churn
CUST-0001,Male,0,No,No,2,Yes,No,Fiber optic,No,No,No,No,No,No,Month-to-month,Yes,Electronic check,85.70,171.40,Yes
CUST-0002,Female,0,Yes,No,1,Yes,Yes,Fiber optic,No,No,No,No,Yes,Yes,Month-to-month,Yes,Electronic check,99.65,99.65,Yes
CUST-0003,Male,1,No,No,3,Yes,No,Fiber optic,No,Yes,No,No,No,No,Month-to-month,Yes,Mailed check,79.85,239.55,Yes
CUST-0004,Female,0,No,No,4,No,No phone service,DSL,No,No,No,No,No,No,Month-to-month,No,Electronic check,45.20,180.80,Yes
CUST-0005,Male,0,Yes,Yes,60,Yes,Yes,Fiber optic,Yes,Yes,Yes,Yes,Yes,Yes,Two year,Yes,Credit card (auto),115.50,6930.00,No
CUST-0006,Female,0,Yes,Yes,48,Yes,No,DSL,Yes,Yes,No,Yes,No,No,One year,No,Bank transfer (auto),55.00,2640.00,No
CUST-0007,Male,0,No,No,36,Yes,No,DSL,Yes,No,No,No,No,No,Two year,No,Bank transfer (auto),49.90,1796.40,No
CUST-0008,Female,1,Yes,No,24,Yes,Yes,Fiber optic,No,Yes,Yes,No,Yes,No,One year,Yes,Credit card (auto),89.10,2138.40,No
CUST-0009,Male,0,Yes,No,12,Yes,No,DSL,No,No,No,No,No,No,Month-to-month,No,Mailed check,55.90,670.80,No
CUST-0010,Female,0,No,Yes,8,Yes,Yes,Fiber optic,No,No,No,No,No,Yes,Month-to-month,Yes,Electronic check,75.40,603.20,Yes
"""

RAW = """\
customerID,gender,SeniorCitizen,Partner,Dependents,tenure,PhoneService,MultipleLines,InternetService,OnlineSecurity,OnlineBackup,DeviceProtection,TechSupport,StreamingTV,StreamingMovies,Contract,PaperlessBilling,PaymentMethod,MonthlyCharges,TotalCharges,Churn
C001,Male,0,Yes,No,1,Yes,No,Fiber optic,No,No,No,No,No,No,Month-to-month,Yes,Electronic check,85.70,85.70,Yes
C002,Female,1,No,No,24,Yes,Yes,DSL,Yes,No,No,Yes,No,No,One year,No,Bank transfer (automatic),55.00,1320.00,No
C003,Male,0,Yes,Yes,60,Yes,Yes,Fiber optic,Yes,Yes,Yes,Yes,Yes,Yes,Two year,No,Credit card (automatic),115.50,6930.00,No
C004,Female,0,No,No,0,No,No phone service,DSL,No,No,No,No,No,No,Month-to-month,Yes,Mailed check,45.20,,Yes
"""
